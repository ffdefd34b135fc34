import random
import zlib

from lexiloom.llm import compression_quality as C

from .edge import documents, frame, prose, write


def labelled(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = rng.random() < 0.6
        text = ". ".join(prose(rng, 12) for _ in range(4)) if y else " | ".join("".join(rng.choices("abcdefgh01234", k=9)) + " buy !!" for _ in range(20))
        rows.append((i, text, int(y)))
    return rows


def test_held_out_accuracy(spark, tmp_path):
    rows = labelled(1)
    awkward = [(10_000 + i, *r[1:]) for i, r in enumerate(documents(1, 10))]
    write(tmp_path, frame(spark, [(d, t, "en", "s", 1) for d, t, _ in rows] + awkward))
    labels = [(d, y, 0) for d, _, y in rows] + [(None, 1, 0), (5, None, 1), (77_777, 1, 0), (1, rows[1][2], 0)]
    write(tmp_path, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "labels")
    got = {r["doc_id"]: r for r in C.query(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) + len(awkward)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
    held = [(got[d]["score"], y) for d, _, y in rows if got[d]["held_out"]]
    assert sum((s >= 0.5) == y for s, y in held) / len(held) > 0.95


def test_labels_of_the_held_out_fold_change_nothing(spark):
    rows = labelled(2, 300)
    docs = frame(spark, [(d, t, "en", "s", 1) for d, t, _ in rows], extra=False)
    both = []
    for flip in (False, True):
        labels = [(d, 1 - y if flip and zlib.crc32(str(d).encode()) % 5 == 0 else y) for d, _, y in rows]
        both.append(C.sample(docs, spark.createDataFrame(labels, "doc_id long, quality int")))
    assert both[0] == both[1]


def test_without_labels(spark):
    docs = frame(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = C.fit(C.sample(docs, none))
    assert {r["score"] for r in C.score(docs, model).collect()} == {0.5}
    assert C.score(docs.limit(0), model).count() == 0


def test_whole_texts_count():
    good, bad = b"alpha beta gamma delta " * 40, b"zzz yyy xxx www " * 40
    sizes = C._sizes_by(good, bad)
    head = "alpha beta gamma delta " * 400
    assert C.features(head + "zzz yyy xxx www " * 400, sizes)[0] < C.features(head + head, sizes)[0]
    assert C.features(None, sizes) is None and C.features(" \n", sizes) is None


def test_labelled_texts_all_blank(spark):
    docs = frame(spark, [(i, [None, "", " \n"][i % 3], "en", "s", 1) for i in range(60)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int")
    rows = C.sample(docs, labels)
    model = C.fit(rows)
    assert {r["score"] for r in C.score(docs, model).collect()} == {sum(y for _, y, _ in rows) / len(rows)}


def test_score_from_sizes_alone():
    """The score again, from compressed sizes taken one by one and the calibration's formula."""
    import math

    import zstandard

    model = C.fit([(t, y, d) for d, t, y in labelled(3, 400)])
    for text in ("ala bor cen. dug efi " * 30, "x" * 9000, "buy !! | abc0 " * 700):
        data, sizes = text.encode(), [0, 0, 0]
        for at in range(0, len(data), 4096):
            for k, raw in enumerate((None, model.good, model.bad)):
                args = {} if raw is None else {"dict_data": zstandard.ZstdCompressionDict(raw)}
                sizes[k] += len(zstandard.ZstdCompressor(level=3, write_content_size=False, **({"write_dict_id": False} if args else {}), **args).compress(data[at : at + 4096]))
        none, good, bad = sizes
        x = [(bad - good) / none, (none - good) / none, (none - bad) / none, none / (len(data) + 20), (bad - good) / (len(data) + 20)]
        z = model.weights[-1] + sum(w * (v - m) / s for w, v, m, s in zip(model.weights, x, model.mean, model.scale, strict=False))
        assert abs(model.scores([text])[0] - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))) < 1e-6


def test_fitted_on_whole_texts(spark):
    rows = [(i, "plain words " * 900 + f"end {i}", "en", "s", 1) for i in range(20)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    got = C.sample(frame(spark, rows, extra=False), labels)
    assert got and {t for t, _, _ in got} <= {r[1] for r in rows}
