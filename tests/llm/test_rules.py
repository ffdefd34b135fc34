import re

import duckdb

from lexiloom.llm import quality_rules as Q

from .edge import documents, frame, write

TEXTS = [None, "", " \n", "one two three four five six seven eight nine ten", "a b c d e f a b c d e f a b c d e f", "x x x x x x x x x x x x", "line\nline\n\nline\n line\n", "# * $ % & | < >", "a\x0bb\x1cc d", "É! Ü! WOW!! ÀÉ", "you idiot, stupid!", "tab\tand\x0cform\rreturn", "😀 " * 12]


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for k in range(len(words) - 4):
        windows.setdefault(tuple(words[k : k + 5]), []).append(k)
    covered = {p + j for at in windows.values() if len(at) > 1 for p in at for j in range(5)}
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_query(spark, tmp_path):
    rows = documents(5, 60) + [(1000 + i, t, None, None, None) for i, t in enumerate(TEXTS)]
    got = Q.query(spark, write(tmp_path, frame(spark, rows))).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], *r[1:7]) for r in got) == sorted((-1 if d is None else d, *plain(t)) for d, t, *_ in rows)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_sql_agrees(spark, tmp_path):
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS + [r[1] for r in documents(7, 40)]) if t is None or len(t) < 50_000]
    path = write(tmp_path, frame(spark, rows, extra=False))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/documents.parquet/*.parquet'")
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits"]
    want = con.execute(f"select {', '.join(cols)} from ({Q.ORACLE})").fetchall()
    assert sorted(tuple(r[c] for c in cols) for r in Q.query(spark, path).collect()) == sorted(want)


def test_no_python_on_the_executors(spark, tmp_path):
    plan = Q.query(spark, write(tmp_path, frame(spark)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_filter_and_policies(spark):
    df = frame(spark)
    for policy in Q.POLICIES:
        kept = Q.filter_rows(df, policy)
        assert kept.columns == df.columns
        led = Q.verdict(Q.ledger(df), policy)
        assert kept.count() == led.where("kept").count()
    assert Q.filter_rows(df.limit(0)).count() == 0


def test_ablations(spark):
    led = Q.ledger(frame(spark)).cache()
    rows = [(r["fail_bits"], r) for r in led.collect()]
    m = Q.POLICIES["strict-1"]
    for r in Q.ablations(led, "strict-1").collect():
        bit = 1 << Q.RULES[r["rule"]][0]
        assert (r["n_fails"], r["n_alone"]) == (sum(bool(b & bit) for b, _ in rows), sum(b & m == bit for b, _ in rows))
    assert len({b for b, _ in Q.RULES.values()}) == len(Q.RULES)
