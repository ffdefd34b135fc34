import hashlib
import random

import pytest

from lexiloom.llm import substring_dedup as S

from .edge import documents, frame, write


def brute(rows, length):
    """Each row's bytes covered by a string of `length` bytes that starts elsewhere too."""
    raw = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in raw:
        for a in range(len(b) - length + 1):
            seen[b[a : a + length]] = seen.get(b[a : a + length], 0) + 1
    out = []
    for (i, _), b in zip(rows, raw, strict=True):
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if seen[b[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((-1 if i is None else i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def result(df, length):
    return sorted((-1 if r["_id"] is None else r["_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.dedup(df, length=length).collect())


def corpus(seed, alphabet, n=40, long=400):
    rng = random.Random(seed)
    parts = ["".join(rng.choices(alphabet, k=rng.randint(1, 90))) for _ in range(12)]
    rows = []
    for i in range(n):
        rows.append((i, "".join(rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(rng.randint(0, long // 40)))))
    return [*rows, (n, None), (n + 1, "aé" * 300), (n + 2, "z" * 500), (n + 3, "z" * 39), rows[3], rows[3], (3, rows[4][1]), (None, rows[5][1])]


@pytest.mark.parametrize("seed,alphabet", [(1, "ab"), (2, "abcdefgh "), (3, "aé€"), (4, "a")])
def test_brute_force(spark, seed, alphabet):
    rows = corpus(seed, alphabet)
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 40) == brute(rows, 40)


@pytest.mark.parametrize("most", [1, 3])
def test_frequent_triggers(spark, monkeypatch, most):
    """The same, where triggers are too frequent for a partition of the dictionary."""
    monkeypatch.setattr(S, "MOST_PHRASES", most)
    rows = corpus(5, "abc")
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 40) == brute(rows, 40)


@pytest.mark.parametrize("length", [5, 8, 40, 100])
def test_suffix_order(length):
    import numpy as np

    rng = random.Random(length)
    data = bytes(rng.choice(b"ab") for _ in range(300)) + b"abba" * 60
    rank = S.suffix_ranks(np.frombuffer(data, "u1"), length)
    cut = [data[i : i + length].ljust(length, b"\0") for i in range(len(data))]
    order = {c: k for k, c in enumerate(sorted(set(cut)))}
    assert rank.tolist() == [order[c] for c in cut]
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 3 * length))) for _ in range(30)]
    pieces[3] = pieces[7][1:] + b"ab"
    seen = [p[a : a + length] for p in pieces for a in range(len(p) - length + 1)]
    for p, runs in zip(pieces, S.repeated(pieces, length), strict=True):
        got = {a for x, y in runs for a in range(x, y + 1)}
        assert got == {a for a in range(len(p) - length + 1) if seen.count(p[a : a + length]) > 1}


def test_query_at_its_length(spark, tmp_path):
    rows = [r for r in documents(4, 60) if r[1] is None or len(r[1]) < 20_000]
    got = S.query(spark, write(tmp_path, frame(spark, rows)))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], *r[1:]) for r in got.collect()) == brute([(r[0], r[1]) for r in rows], 400)


def test_long_texts_and_no_rows(spark):
    rows = [(1, "word " * 60_000), (2, "x" * 200_000)]
    assert [r[2] for r in result(spark.createDataFrame(rows, "doc_id long, text string"), 400)] == [300_000, 200_000]
    assert result(spark.createDataFrame([], "doc_id long, text string"), 400) == []


def test_triggers():
    import numpy as np

    rng = np.random.default_rng(1)
    grams = rng.integers(0, 1 << 63, 500, dtype="u8")
    grams[::7] = grams[0]
    got = S.triggers(grams, 37)
    key = grams >> np.uint64(22)
    assert got.tolist() == [s + int(np.argmin(key[s : s + 37])) for s in range(len(grams) - 36)]
