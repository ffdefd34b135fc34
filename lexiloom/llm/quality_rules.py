"""Quality rules as a bitmask ledger, in DataFrame functions only.

measure() computes each measurement once; ledger() evaluates each rule once and keeps the outcome as one bit.
A policy is a mask over those bits, so another version of it, or the question what a rule alone rejects, needs
no second look at the text.

Edge cases: a null or empty text has no words, measures 0 everywhere and fails few_words. Rows that repeat
are judged each for itself. Columns of the input other than id and text are not touched and not returned by
measure(); filter_rows() returns the input's columns alone. An empty table gives an empty ledger.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import SPACES, let, read, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Bits of a number that hold a place in an array, which has fewer than 2^31 items.
PLACE_BITS = 31
#: Insults of the lexicon rule; matched as whole words in any case.
INSULTS = ("idiot", "idiots", "moron", "morons", "worthless", "stupid", "scum", "vermin", "imbecile")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclaim", "n_upper", "n_adjacent", "n_insults")

#: Rule to (bit, condition over the measurements). A bit, once given, is never used for another rule.
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 10"),
    "repeated_windows": (1, "100 * n_repeat_words > 20 * n_words"),
    "symbols": (2, "10 * n_symbols > n_words"),
    "exclamations": (3, "5 * n_exclaim > n_words"),
    "capitals": (4, "2 * n_upper > word_chars"),
    "duplicate_lines": (5, "10 * n_dup_lines > 6 * n_lines"),
    "adjacent_words": (6, "100 * n_adjacent > 30 * n_words"),
    "insults": (7, "n_insults > 0"),
}


def mask(*names: str) -> int:
    return sum(1 << RULES[n][0] for n in names)


BASE = mask("few_words", "repeated_windows")
#: Versioned policies: a mask of the rules that reject.
POLICIES: dict[str, int] = {
    "base-1": BASE,
    "prose-1": BASE | mask("symbols", "exclamations", "capitals", "adjacent_words"),
    "strict-1": BASE | mask("symbols", "exclamations", "capitals", "adjacent_words", "duplicate_lines", "insults"),
}
POLICY = "prose-1"


def _insults(text: Column) -> Column:
    """Insults in the text. One that holds none of their letters in a row is not searched for whole words."""
    low = F.lower(text)
    stems = [x for x in INSULTS if not any(y != x and y in x for y in INSULTS)]
    some = reduce(or_, [F.contains(low, F.lit(x)) for x in stems])
    return F.when(some, F.regexp_count(text, F.lit(r"(?i)\b(?:" + "|".join(INSULTS) + r")\b"))).otherwise(F.lit(0))


def _repeat_words(w: Column) -> Column:
    """Words inside a WINDOW-word window that the text holds twice or more.

    Hashes decide first: where all window hashes differ, no window repeats. Otherwise numbers that hold the lowest bits of a
    hash above the window's place are sorted; windows beside one of the same bits are candidates. These alone are
    sorted as words, with their places, and equal neighbours marked. So a long repetitive text costs n log n."""
    n = F.size(w)
    hashes = F.transform(F.slice(w, 1, n - WINDOW + 1), lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))
    return F.when(n < WINDOW, F.lit(0)).otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(w, h)).otherwise(F.lit(0)))).cast("long")


def _covered(w: Column, hashes: Column) -> Column:
    places = F.lit((1 << PLACE_BITS) - 1)
    keys = F.sort_array(F.transform(hashes, lambda h, i: F.shiftleft(h, PLACE_BITS).bitwiseOR(i.cast("long"))))
    same = lambda x, y: F.coalesce(F.shiftright(x.bitwiseXOR(y), PLACE_BITS) == 0, F.lit(False))
    found = let(keys, lambda s: F.filter(s, lambda x, i: ((i > 0) & same(F.get(s, i - 1), x)) | same(F.get(s, i + 1), x)))
    windows = F.sort_array(F.transform(found, lambda x: let(x.bitwiseAND(places).cast("int"), lambda p: F.struct(F.array_join(F.slice(w, p + 1, WINDOW), " ").alias("w"), p.alias("p")))))
    marked = let(
        windows,
        lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["w"] == x["w"])) | F.coalesce(F.get(s, i + 1)["w"] == x["w"], F.lit(False))), lambda x: x["p"])),
    )
    return let(marked, lambda p: F.aggregate(F.transform(p, lambda x, i: F.coalesce(F.least(F.lit(WINDOW), F.get(p, i + 1) - x), F.lit(WINDOW))), F.lit(0), lambda a, b: a + b))


def _adjacent(w: Column) -> Column:
    """Words that the next word repeats."""
    return F.size(F.filter(w, lambda x, i: F.coalesce(F.get(w, i + 1) == x, F.lit(False))))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and MEASURES, one row for each of docs. No shuffle: a projection over the scan."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    df = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    df = df.select(id_col, text.alias("_text"), words(text).alias("_words"))
    # let() keeps a measurement in one piece: moved below by the optimizer, it still splits the text once
    t, w = F.col("_text"), F.col("_words")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    n_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    df = df.select(
        id_col,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        n_lines.alias("_lines"),
        let(w, _repeat_words).alias("n_repeat_words"),
        (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("n_exclaim"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        let(w, _adjacent).cast("long").alias("n_adjacent"),
        _insults(t).cast("long").alias("n_insults"),
    )
    return df.select(id_col, *[F.col("_lines")["n"].cast("long").alias(m) if m == "n_lines" else F.col("_lines")["dup"].cast("long").alias(m) if m == "n_dup_lines" else F.col(m) for m in MEASURES])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """measure() with fail_bits: bit b is set where the rule of that bit fails."""
    bits = " | ".join(f"(CASE WHEN {cond} THEN {1 << bit}L ELSE 0L END)" for bit, cond in RULES.values())
    return measure(docs, id_col, text_col).withColumn("fail_bits", F.expr(bits))


def verdict(led: DataFrame, policy: str = POLICY, out: str = "kept") -> DataFrame:
    return led.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def filter_rows(docs: DataFrame, policy: str = POLICY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that the policy keeps, with their own columns. Each row is judged by itself, so ids need not be unique."""
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    led = ledger(named.select(F.col("_row"), F.col("_row")[text_col].alias("text")), "_row", "text")
    # a filter moves below a projection and takes the measurements' expressions with it, once for each rule that names
    # them; it stays above one that numbers the rows
    judged = verdict(led, policy).select("_row", "kept", F.monotonically_increasing_id().alias("_number"))
    return judged.where("kept AND _number >= 0").select("_row.*")


def ablations(led: DataFrame, policy: str = POLICY) -> DataFrame:
    """For each rule of a policy: rows that fail it, and rows that it alone rejects. One aggregation over the ledger's bits."""
    m = POLICIES[policy]
    failed = F.col("fail_bits").bitwiseAND(F.lit(m))
    aggs = []
    for name, (bit, _) in RULES.items():
        if m >> bit & 1:
            aggs += [F.count_if(failed.bitwiseAND(F.lit(1 << bit)) != 0).alias(f"{name}__fails"), F.count_if(failed == (1 << bit)).alias(f"{name}__alone")]
    one = led.agg(*aggs)
    used = [n for n, (bit, _) in RULES.items() if m >> bit & 1]
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"{n}__fails").alias("n_fails"), F.col(f"{n}__alone").alias("n_alone")) for n in used]))
    return one.select(rows.alias("r")).select("r.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = verdict(ledger(read(spark, sf_dir, "documents")))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0).alias("base_failed"), "kept", "fail_bits")


_BITS = " | ".join(f"(CASE WHEN {cond} THEN {1 << bit} ELSE 0 END)" for bit, cond in RULES.values())
#: The ledger over a relation named documents; also the first step of the pipeline's SQL.
LEDGER_SQL = rf"""
t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]', '', 'g') <> '') AS l FROM t),
p AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, w FROM s WHERE len(w) >= 5),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 4], ' ') AS g FROM p),
d AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT p + k) AS n_repeat_words FROM g JOIN d USING (doc_id, g), (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
m AS (SELECT s.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    (length(text) - length(replace(text, '!', '')))::BIGINT AS n_exclaim,
    (length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')))::BIGINT AS n_upper,
    len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1]))::BIGINT AS n_adjacent,
    len(regexp_extract_all(text, '(?i)\b(?:{"|".join(INSULTS)})\b'))::BIGINT AS n_insults
    FROM s LEFT JOIN c ON s.doc_id = c.doc_id),
ledger AS (SELECT *, ({_BITS})::BIGINT AS fail_bits FROM m)"""

ORACLE = f"""WITH {LEDGER_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {BASE}) <> 0 AS base_failed,
    (fail_bits & {POLICIES[POLICY]}) = 0 AS kept, fail_bits FROM ledger"""
