import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lexiloom.llm import packing as P

from .edge import documents, frame, write


def plain_best_fit(lengths, capacity):
    """Bins of best-fit decreasing, one piece after another."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(capacity - n)
    return len(left)


def lay(histogram, capacity):
    bins = {}
    for n, entries in P.best_fit(histogram, capacity).items():
        for r in range(histogram[n]):
            item, first, each, offset = [e for e in entries if e[0] <= r][-1]
            bins.setdefault(first + (r - item) // each, []).append((offset + (r - item) % each * n, n))
    return bins


@pytest.mark.parametrize("seed", range(25))
def test_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 64, 100])
    lengths = [rng.randint(1, rng.choice([capacity, capacity // 2, 5])) for _ in range(rng.randint(0, 300))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    bins = lay(histogram, capacity)
    assert sorted(n for b in bins.values() for _, n in b) == sorted(lengths)
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(bins) == plain_best_fit(lengths, capacity)


def test_tightest():
    tree = P.Tightest(20)
    rng, open_ = random.Random(1), set()
    for _ in range(500):
        k = rng.randint(0, 20)
        tree.set(k, k not in open_)
        open_ ^= {k}
        least = rng.randint(0, 20)
        assert tree.first(least) == min((x for x in open_ if x >= least), default=-1)


TEXTS = ["Hello, World! It's 3.14", "a\x1cb\x1dc d", "İstanbul ĞÜŞ ﬁ ½ Å", "日本語 text", "<|endoftext|> x <|startoftext|>", "", " \n ", None, "don't we'll I'M", "x" * 3000, "a" * 50 + "!" * 60, "emoji 😀😀 ok", "ﬀ́é  nbsp em", "___ ... --- '''", "0123456789" * 20]


def test_ids_are_those_of_the_tokenizer():
    path = P.tokenizer_path(None)
    plain, own = Tokenizer.from_file(path), P.WordEncoder(path)
    rng = random.Random(3)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices("aàÀ éßñ'12.,!?-_ \n\t|<>İ\x1c日", k=60)) for _ in range(300)]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_query(spark, tmp_path):
    rows = documents(2, 60)
    got = P.query(spark, write(tmp_path, frame(spark, rows))).collect()
    tokenizer = Tokenizer.from_file(P.tokenizer_path(None))
    want = []
    for d, t, *_ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((-1 if d is None else d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(bins) == plain_best_fit([w[3] for w in want], 4096)


def test_nothing_and_bad_lengths(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack(P.pieces(empty)).count() == 0
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([(1, 5000)], "doc_id long, length long"))
