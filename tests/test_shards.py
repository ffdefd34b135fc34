import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.operators.shards import assign_shards, chunk_of_start, cut_text, split_texts, stream_shards, write_text_shards
from lexiloom.operators.streams import running_total


@given(st.text(alphabet="aç€😀\n", max_size=300), st.integers(4, 50))
def test_cut_text(text, limit):
    parts = cut_text(text, limit)
    assert "".join(parts) == text
    assert all(len(p.encode()) <= limit for p in parts)


def test_cut_prefers_line_ends():
    assert cut_text("aaa\nbbb\nccc", 9) == ["aaa\nbbb\n", "ccc"]
    assert cut_text("x" * 8, 8) == ["x" * 8]
    with pytest.raises(ValueError):
        cut_text("😀😀", 3)


@pytest.mark.parametrize("slices", [1, 7, 100])
def test_running_total(spark, slices):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(40)]), i, rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, i int, n long").repartition(5)
    got = {r["i"]: r["start"] for r in running_total(df, "k", "n", slices=slices, ties=("i",)).collect()}
    total = 0
    for _, i, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        assert got[i] == total
        total += n
    assert running_total(df.limit(0), "k", "n").count() == 0


def docs(spark, n=200, seed=3):
    rng = random.Random(seed)
    rows = [(i, None if i % 17 == 0 else "".join(rng.choice("abc ğ\n") for _ in range(rng.choice([0, 5, 50, 400])))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_shards_stay_under_the_limit(spark, tmp_path):
    df, rows = docs(spark)
    limit = 300
    got = assign_shards(df, limit).collect()
    size = {}
    for r in got:
        size[r["shard"]] = size.get(r["shard"], 0) + len((r["text"] or "").encode()) + 1
    assert max(size.values()) <= limit and len(size) > 10
    whole = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["part"])):
        whole[r["doc_id"]] = None if r["text"] is None else whole.get(r["doc_id"], "") + r["text"]
    assert whole == dict(rows)
    write_text_shards(df, str(tmp_path / "out"), limit)
    files = list((tmp_path / "out").rglob("*.txt"))
    assert all(f.stat().st_size <= limit for f in files) and len(files) == len({f.parent for f in files})


def test_split_keeps_other_columns(spark):
    df = spark.createDataFrame([("a", "x" * 10, 1), ("b", None, 2), ("c", "", 3)], "id string, text string, part_of int")
    got = sorted((r["id"], r["part"], r["text"], r["part_of"]) for r in split_texts(df, 4).collect() if r["text"] is not None)
    assert got == [("a", 0, "xxxx", 1), ("a", 1, "xxxx", 1), ("a", 2, "xx", 1), ("c", 0, "", 3)]


def test_stream_and_chunks(spark):
    df, rows = docs(spark)
    pieces = stream_shards(df, 64).collect()
    total = sum(len((t or "").encode()) for _, t in rows)
    assert sum(r["length"] for r in pieces) == total
    assert all((r["start"] // 64) + 1 == r["shard"] and (r["start"] + r["length"] - 1) // 64 + 1 == r["shard"] for r in pieces)
    chunks = chunk_of_start(df, 64)
    assert chunks.agg(F.sum("bytes")).first()[0] == total and chunks.agg(F.sum("n_docs")).first()[0] == len(rows)
