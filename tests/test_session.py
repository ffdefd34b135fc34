from pathlib import Path

from lexiloom import session


def places(spark):
    return {p.name for p in Path(session.shared_dir(spark).removeprefix("file://")).glob("lexiloom-stage-*")}


def test_released_goes_and_what_was_made_of_it_stays(spark):
    before = places(spark)
    one = session.stored(spark.range(10))
    two = session.stored(one.where("id > 6"))
    assert len(places(spark) - before) == 2
    session.released(one, spark.range(3))
    session.released(one)
    assert len(places(spark) - before) == 1
    assert [r["id"] for r in two.orderBy("id").collect()] == [7, 8, 9]


def test_settled_keeps_its_result_alone(spark):
    before = places(spark)

    def make():
        inner = session.settled(lambda: session.stored(spark.range(5)))
        return inner.join(session.stored(spark.range(3)), "id")

    kept = session.stored(spark.range(1))
    out = session.settled(make)
    assert len(places(spark) - before) == 2
    assert out.count() == 3 and kept.count() == 1
