import math
import re

from lexiloom.llm import mixing as M

from .edge import documents, frame, write


def n_words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(sizes):
    """The shares by refilling until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(order)}
    total, out, free = sum(sizes.values()), {}, set(order)
    while free:
        left, w = total - sum(out.values()), sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / w > 3 * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / w for s in free}
            break
        out |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return out


def test_query(spark, tmp_path):
    rows = documents(9, 160)
    path = write(tmp_path, frame(spark, rows))
    got = M.query(spark, path).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, M.query(spark, path).collect()))
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + n_words(t)
    want, source = targets(sizes), {}
    assert sorted(r["size"] for r in got) == sorted(n_words(r[1]) for r in rows)
    by_size = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_size.setdefault((r["source_size"], round(r["target"], 6)), []).append(r["taken"])
    assert {(sizes[s], round(want[s], 6)) for s in sizes} == set(by_size)
    total = sum(sizes.values())
    for s in sizes:
        same = [x for x in sizes if (sizes[x], round(want[x], 6)) == (sizes[s], round(want[s], 6))]
        assert abs(sum(by_size[sizes[s], round(want[s], 6)]) - len(same) * want[s]) <= len(same) * (1 + total / 2**14)
    assert not source


def test_apply_takes_what_the_plan_says(spark):
    rows = documents(9, 80)
    df = frame(spark, rows)
    out = M.apply(df)
    assert out.columns == df.columns
    # rows that are equal share what they take, rounded down
    plan, got = M.plan(df).collect(), out.collect()
    taken = {}
    for r in plan:
        taken[r["_id"]] = taken.get(r["_id"], 0) + r["_taken"]
    have = {}
    for r in got:
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + n_words(r["text"])
    assert {k: v for k, v in have.items() if k != 5} == {k: v for k, v in taken.items() if v and k != 5}
    assert taken[5] - 3 <= have.get(5, 0) <= taken[5]
    text = {}
    for d, t, *_ in rows:
        text.setdefault(d, []).append(t)
    assert all(any((t or "").lstrip(" \t\n\v\f\r").startswith(r["text"].strip(" \t\n\v\f\r")) for t in text[r["doc_id"]]) for r in got)


def test_the_mix_by_brute_force(spark):
    """The schedule slot by slot: each slot's point names its source and takes the next block of that source's stream."""
    rows = [(i, f"s{i % 3} " + " ".join(f"w{k}" for k in range(40 + 7 * i % 300)), None, f"src{i % 3}" if i % 40 else "tiny", None) for i in range(400)] + [(900, "one two", None, "z", None)]
    df = frame(spark, rows)
    by = {r["_source"]: r for r in M.targets(M.sizes(df)).collect()}
    plan = M.plan(df).collect()
    n = by["src0"]["_n"]
    assert n >= 64
    bits = n.bit_length() - 1
    total, edge, owner = sum(r["_target"] for r in by.values()), 0.0, []
    for s in sorted(by):
        edge += by[s]["_target"]
        owner.append((edge / total, s))
    slots = {s: [] for s in by}
    for j in range(n):
        v = int(f"{j:0{bits}b}"[::-1], 2) / n
        slots[next(s for e, s in owner if v < e)].append(j)
    for s in by:
        if not slots[s]:
            before = max((e for e, x in owner if x < s), default=0.0)
            slots[s] = [int(f"{math.ceil(before * n) - 1:0{bits}b}"[::-1], 2)]
    want = {}
    for s, r in by.items():
        stream = sorted((x for x in plan if x["_source"] == s), key=lambda x: (x["_order"] & (1 << 64) - 1, x["_id"]))
        at = 0
        while at < r["_quota"]:
            for x in stream:
                if x["_size"] and at < r["_quota"]:
                    words = min(x["_size"], r["_quota"] - at)
                    rank = at * len(slots[s]) // r["_quota"]
                    want.setdefault(x["_id"], []).append((rank, slots[s][rank], words))
                    at += words
    assert {x["_id"]: [tuple(t) for t in x["_times"]] for x in plan if x["_times"]} == want
    assert sum(x["_taken"] for x in plan) == sum(r["_quota"] for r in by.values())
    mixed = M.apply(df, slot_col="slot").collect()
    assert [r["slot"] for r in mixed] == sorted(r["slot"] for r in mixed)
    assert sorted((r["doc_id"], r["slot"], n_words(r["text"])) for r in mixed) == sorted((d, s, w) for d, t in want.items() for _, s, w in t)


def test_schedule_is_even(spark):
    df = frame(spark, documents(9, 160))
    by = M.targets(M.sizes(df))
    slots = sorted((r["slot"], r["_source"], r["rank"]) for r in M.schedule(by).collect())
    n = len(slots)
    assert [s for s, *_ in slots] == list(range(n)) and n & (n - 1) == 0
    share = {r["_source"]: r["_slots"] / n for r in by.collect()}
    seen = {}
    for k, (_, s, rank) in enumerate(slots, 1):
        assert rank == seen.get(s, 0)
        seen[s] = rank + 1
        if k % 64 == 0:
            assert all(abs(seen.get(x, 0) - share[x] * k) <= 8 for x in share)


def test_nothing(spark):
    df = frame(spark)
    assert M.plan(df.limit(0)).count() == 0 and M.apply(df.limit(0)).count() == 0
    blank = frame(spark, [(1, None, None, "a", None), (2, " ", None, None, None)])
    assert [(r["_taken"], r["_target"]) for r in M.plan(blank).collect()] == [(0, 0.0)] * 2


def test_small_sources_beside_large_ones(spark):
    rows = [("a", 1_700_000_000), ("b", 1000), ("c", 2_000_000_000), ("d", 900), ("e", 1_300_000_000), ("f", 1200)]
    by = M.targets(spark.createDataFrame(rows, "_source string, _size long")).collect()
    want = targets(dict(rows))
    assert all(abs(r["_target"] - want[r["_source"]]) < 1e-3 and abs(r["_quota"] - want[r["_source"]]) <= 1 for r in by)
    assert all(r["_quota"] > 0 for r in by)
