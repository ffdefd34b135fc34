import hashlib
import random
import re

from lexiloom.llm import line_dedup as L

from .edge import documents, frame, prose, write


def plain(rows):
    """Texts left when all but the first of equal chunks go."""
    first = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    left = {}
    for i in order:
        d, t = rows[i]
        if t is None:
            left[i] = None
            continue
        lines, out = t.split("\n"), []
        for k, (a, n) in enumerate(L.chunks(t)):
            piece = "\n".join(lines[a : a + n])
            if n >= 2 and piece.strip() and first.setdefault(piece, (d, k, t)) != (d, k, t):
                continue
            out += lines[a : a + n]
        left[i] = "\n".join(out)
    return [left[i] for i in range(len(rows))]


def corpus(seed):
    rng = random.Random(seed)
    shared = [[prose(rng, 6) for _ in range(rng.randint(4, 20))] for _ in range(5)]
    rows = []
    for i in range(60):
        lines = [prose(rng, 6) for _ in range(rng.randint(0, 8))]
        if i % 2:
            part = list(rng.choice(shared))
            at = rng.randint(0, len(lines))
            lines[at:at] = part
        rows.append((i, "\n".join(lines)))
    return [*rows, (60, None), (61, ""), (62, "\n\n\n\n"), (63, "\n".join(["same"] * 500)), (64, "\n".join(["same"] * 400)), rows[7]]


def test_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        got = L.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), counts=True).collect()
        assert sorted((r["doc_id"], r["text"] or "", r["text"] is None) for r in got) == sorted((d, t or "", t is None) for (d, _), t in zip(rows, plain(rows), strict=True))
        assert sum(r["n_removed"] for r in got) > 100


def test_boundaries_resist_shifts():
    rng = random.Random(3)
    lines = [prose(rng, 7) for _ in range(200)]
    one, two = "\n".join(lines), "\n".join([*lines[:50], "inserted", *lines[50:]])
    a, b = {p for _, p in L.chunk_texts(one)}, {p for _, p in L.chunk_texts(two)}
    assert len(a - b) <= 3


def test_query_and_columns(spark, tmp_path):
    rows = documents(8, 60)
    df = frame(spark, rows)
    got = L.query(spark, write(tmp_path, df)).collect()
    assert len(got) == len(rows)
    assert {r["kept_sha256"] for r in got if r["doc_id"] == 60} == {hashlib.sha256(b"").hexdigest()}
    out = L.dedup(df)
    assert out.columns == df.columns and out.count() == len(rows)
    assert L.dedup(df.limit(0)).count() == 0


def plain_extended(rows):
    """Texts left when all but the first of equal chunks and equal passages go, line by line."""
    first, left = {}, {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0)):
        d, t = rows[i]
        if t is None:
            left[i] = None
            continue
        lines, gone = t.split("\n"), set()
        worded = [k for k, x in enumerate(lines) if x.strip()]
        for a, b in sorted({(a, a + n) for a, n in L.chunks(t) if n >= 2} | {(a, b + 1) for a, b in zip(worded, worded[1:])}):
            piece = "\n".join(lines[a:b])
            if piece.strip():
                e, at, u = first.setdefault(piece, (d, a, t))
                if (e, at, u) != (d, a, t):
                    gone |= set(range(max(a, at + b - a) if (e, u) == (d, t) else a, b))
        left[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return [left[i] for i in range(len(rows))]


def test_extended_brute_force(spark):
    for seed in (3, 4):
        rows = [*corpus(seed), (None, "no id\nof its own"), (None, "other\nno id\nof its own"), (70, "a\n\n\n\nb\nc"), (71, "x\na\n\n\n\nb\ny")]
        got = L.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), counts=True, extend=True).collect()
        want = plain_extended(rows)
        # two rows without an id are in order of their texts' hash, so either may keep the passage
        loose = lambda d, t: (d is None, d or 0, None if d is None else t)
        key = lambda x: (*x[:2], x[2] is None, x[2] or "")
        assert sorted((loose(r["doc_id"], r["text"]) for r in got), key=key) == sorted((loose(d, t) for (d, _), t in zip(rows, want, strict=True)), key=key)
        assert sum(r["n_removed"] for r in got if r["doc_id"] is None) == 2
        assert {r["doc_id"]: r["text"] for r in got}[71] == "x\ny"
        # the first of equal lines stays
        assert {x for _, t in rows for x in (t or "").split("\n") if x.strip()} == {x for r in got for x in (r["text"] or "").split("\n") if x.strip()}


def planted(n_lines, n=40):
    rng = random.Random(n_lines)
    rows = []
    for k in range(n):
        part = [prose(rng, 8) for _ in range(n_lines)]
        for i in range(2):
            rows.append((2 * k + i, "\n".join([prose(rng, 8) for _ in range(3)] + part + [prose(rng, 8) for _ in range(3)])))
    return rows


def test_planted_passages_go_whole(spark, tmp_path):
    for n_lines in (2, 3, 4, 6):
        path = tmp_path / str(n_lines)
        path.mkdir()
        got = L.query(spark, write(path, frame(spark, planted(n_lines), False, "doc_id long, text string"))).collect()
        assert {r["doc_id"]: r["n_removed"] for r in got} == {i: n_lines * (i % 2) for i in range(80)}


def test_text_moves_once_and_only_changed_texts_go_through_python(spark):
    rows = corpus(5)
    df = spark.createDataFrame([(d, "src", t) for d, t in rows], "doc_id long, source string, text string")
    out = L.dedup(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"] or "", r["text"] is None) for r in out.collect()) == sorted((d, t or "", t is None) for (d, _), t in zip(rows, plain(rows), strict=True))
    plan = out._jdf.queryExecution().analyzed().toString()
    assert re.search(r"struct\(doc_id, doc_id#\d+L?, source, source#\d+\) AS _row", plan)
    assert re.search(r"cut\(CASE WHEN isnotnull\(_gone#\d+\) THEN _text#\d+ END, _gone#\d+\)", plan)
