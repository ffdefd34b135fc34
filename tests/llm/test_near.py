import random
import re

import pytest

from lexiloom.llm import near_dups as N
from lexiloom.llm.components import components

from .edge import documents, frame, prose, write


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(size, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()


def brute(rows, size, per_cent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= per_cent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.choice([1, 2, 3, 6, 40, 120]))) for i in range(40)]
    for i in range(40, 120):
        words = rng.choice(rows)[1].split(" ")
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(["new", "Other", "ALA"])
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    return [*rows, (120, None), (121, ""), (122, " \t\n"), (123, "É é\xa0x"), (124, "é É\xa0x"), (7, rows[9][1])]


@pytest.mark.parametrize("seed,size,per_cent", [(1, 3, 85), (2, 5, 80), (3, 1, 90)])
def test_brute_force(spark, seed, size, per_cent):
    rows = corpus(seed)
    got = N.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), size=size, per_cent=per_cent)
    assert sorted((r["_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute(rows, size, per_cent)


def test_query_and_awkward_rows(spark, tmp_path):
    rows = [r for r in documents(3, 60)]
    got = N.query(spark, write(tmp_path, frame(spark, rows))).collect()
    assert len(got) == len(rows)
    want = brute([(r[0], r[1]) for r in rows if r[0] is not None], 3, 85)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)


def test_keep_one(spark):
    rows = documents(3, 60)
    df = frame(spark, rows)
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    want = brute([(r[0], r[1]) for r in rows if r[0] is not None], 5, 80)
    alone = {d for d, _, c in want if d == c}
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} == alone
    assert N.keep_one(df.limit(0)).count() == 0


def test_one_large_group(spark):
    rng = random.Random(9)
    base = prose(rng, 200).split(" ")
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(200)] = f"w{i % 150}"
        rows.append((i, " ".join(words)))
    got = N.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r["component_id"] for r in got.collect()} == {0}


def nearly_linked(seed, n):
    """Documents of one family, 6 of 300 words replaced in each: similar to about 0.79, so nearly none are linked."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(300), 6):
            words[k] = f"x{i}y{k}"
        rows.append((i, " ".join(words)))
    # some that share five of their six places, so are linked
    for i in range(0, n // 10):
        rows.append((n + i, rows[i][1].replace(f"x{i}y", f"x{i}y", 1).replace("w7 ", "v7 ", 1)))
    return rows


def test_unlinked_family_makes_few_pairs(spark, monkeypatch):
    made = {}
    for n in (100, 300):
        counts = []
        whole = N._confirmed
        monkeypatch.setattr(N, "_confirmed", lambda pairs, *a, f=whole, c=counts: (c.append(pairs.count()), f(pairs, *a))[1])
        rows = nearly_linked(3, n)
        got = N.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
        assert sorted((r["_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute(rows, 3, 85)
        monkeypatch.setattr(N, "_confirmed", whole)
        made[n] = counts
    assert all(c[1] <= 2 * n for n, c in made.items()), made  # pairs met across components


def test_word_hashes():
    rng = random.Random(6)
    for stretch in (64, 1 << 20):
        N.STRETCH = stretch
        texts = ["", " ", "a", " a  b\t", "x" * 300 + " y", *["".join(rng.choices("ab \n\x0bé", k=rng.randint(1, 400))) for _ in range(200)]]
        seen = {}
        for t in texts:
            words = t.encode().split()
            got = N.word_hashes(t.encode()).tolist()
            assert len(got) == len(words)
            for w, h in zip(words, got, strict=True):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_long_sketches_never_rule_out():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 20, 300, 5000):
        a = np.unique(rng.integers(0, 1 << 62, n, dtype="u8"))
        b = np.unique(np.concatenate((a[: n - n // 9], rng.integers(0, 1 << 62, n // 7, dtype="u8"))))
        x, y = N.long_sketch(a), N.long_sketch(b)
        while len(x) != len(y):
            x, y = (x[: len(y)] ^ x[len(y) :], y) if len(x) > len(y) else (x, y[: len(x)] ^ y[len(x) :])
        differ = sum(int(v).bit_count() for v in (x ^ y).view("u8"))
        true = len(np.setxor1d(a, b))
        assert differ <= true and differ >= 0.6 * true


def test_null_ids_and_repeated_ids(spark):
    rng = random.Random(12)
    text = prose(rng, 60)
    near = text.replace(text.split(" ")[30], "zzz", 1)
    far = prose(rng, 60)
    rows = [(None, text), (4, near), (2, far), (2, near)]
    got = sorted(((r["_id"], r["component_id"]) for r in N.classes(spark.createDataFrame(rows, "doc_id long, text string"), size=1).collect()), key=str)
    assert got == [(2, 2), (2, 2), (4, 2), (None, 2)]
    kept = N.keep_one(spark.createDataFrame([(1, text), (2, near), (2, far)], "doc_id long, text string"), size=1).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(1, text), (2, far)])


def test_entries_meet_within_the_distance():
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, N.SYMBOLS, dtype="u8")
        b = a.copy()
        for k in rng.choice(N.SYMBOLS, 2 * N.CHUNKS - 1, replace=False):
            b[k] = (b[k] + np.uint64(1)) & np.uint64(0xFFFF)
        assert set(N.entries(a).tolist()) & set(N.entries(b).tolist())


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(25)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(len(parent)):
        for u, v in edges:
            parent[u] = parent[v] = min(parent[u], parent[v])
    alone = {x for e in edges for x in e} - {x for u, v in edges if u != v for x in (u, v)}
    assert got == {n: r for n, r in parent.items() if n not in alone and n != r}
