"""Personal data in texts: base patterns, and further spans by weak supervision, in DataFrame functions only.

Base spans are the leftmost matches of a pattern for each kind, checked by a rule (parts of an address, Luhn,
digits). Candidates for further spans are what the base may miss: letters and digits long enough to be a secret,
digit groups that are no base span, and given names before capitalised words. Labelers vote on each candidate
(regular expressions on its form, a gazetteer of names, and cues in the words before it): for, against, or
not at all. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is; the
posteriors are the soft labels from which a logistic model of each kind is trained. It does not see the votes: its features
are those of the span and of what stands beside it (length, digits, different characters, changes between letters and digits,
case, cue words, marks before and after), in bins. So it also judges candidates on which few labelers vote, and spans that
it finds likely enough are added.

Votes and bins have a bounded number of patterns (PATTERNS_AT_MOST for a kind), so what the driver collects is bounded
whatever the corpus; the counts are of all texts.

Edge cases: a null or empty text has no spans. Rows that repeat are judged each for itself, and so are rows of one id with
other texts, and rows without id. Patterns do not backtrack over runs, so a text of one long run takes linear time. A corpus
without candidates, or an empty table, adds nothing. Columns of the input may have any names: only id and text are read, under
names of our own. Positions are code points, the end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import let, read, stored

_LOCAL = "[A-Za-z0-9._%+-]"
#: Kind to a pattern with the same leftmost matches as the plain one, written so that no run is scanned twice: a match
#: begins where the run or the search begins, and quantifiers give nothing back.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# fixed values: given names and forms of address
_NAMES = "James|Mary|John|Robert|Michael|William|David|Maria|Anna|Peter|Paul|Thomas|Pierre|Marie|Jean|Hans|Jose|Carmen|Ahmet|Mehmet|Fatma"
_TITLES = "Mr|Mrs|Ms|Dr|Herr|Frau|Señor|Señora|Madame|Monsieur|Sayın"
#: Kinds that the method adds, each with a pattern for its candidates.
EXTRA = {
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+(?![A-Za-z0-9_-])",
    "number": r"(?<![0-9A-Za-z.+-])[0-9]{3,4}+[\x20.-][0-9]{2,4}+[\x20.-][0-9]{3,4}+(?![0-9A-Za-z-])(?!\.[0-9])",
    "name": rf"(?<![\p{{L}}])(?:(?:{_NAMES})|(?<=\b(?:{_TITLES})\.?\x20)\p{{Lu}}[\p{{L}}-]{{1,30}}+)\x20\p{{Lu}}[\p{{L}}-]{{1,30}}+",
}
#: Characters before a candidate that the cue labelers read.
CONTEXT = 24
#: Labelers: a condition over kind, s (the span) and c (the context before it, lowered): 1 for, -1 against, 0 no vote.
LABELERS = {
    "mixed_form": r"CASE WHEN kind <> 'secret' THEN 0 WHEN s RLIKE '[0-9]' AND s RLIKE '[A-Za-z]' THEN 1 ELSE -1 END",
    "hex_form": r"CASE WHEN kind <> 'secret' THEN 0 WHEN s RLIKE '^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$' THEN 1 ELSE 0 END",
    "secret_cue": r"CASE WHEN c RLIKE '(?:token|secret|password|passwd|api.?key|key)[\\x20\'\"]*[=:]' THEN 1 WHEN kind = 'secret' THEN -1 ELSE 0 END",
    "phone_form": r"CASE WHEN kind <> 'number' THEN 0 WHEN s RLIKE '^[0-9]{3}[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}$' THEN 1 ELSE -1 END",
    "phone_cue": r"CASE WHEN kind <> 'number' THEN 0 WHEN c RLIKE '(?:tel|phone|call|fax|mobile|handy|ssn|social)' THEN 1 ELSE -1 END",
    "gazetteer": rf"CASE WHEN kind <> 'name' THEN 0 WHEN s RLIKE '^(?:{_NAMES})\\\\x20' THEN 1 ELSE -1 END",
    "name_cue": r"CASE WHEN kind <> 'name' THEN 0 WHEN c RLIKE '(?:mr|mrs|ms|dr|name|herr|frau|señor|madame|monsieur)[.:]?[\\x20]*$' THEN 1 ELSE -1 END",
}
#: Features of a candidate, each a bin from 0, over s, c and a (the character after the span): the expression, the bins, and whether bins are of one scale.
FEATURES = {
    "length": ("CASE WHEN length(s) < 12 THEN 0 WHEN length(s) < 24 THEN 1 WHEN length(s) < 32 THEN 2 WHEN length(s) < 64 THEN 3 ELSE 4 END", 5),
    "digits": ("CAST(least(3, floor(4.0 * regexp_count(s, '[0-9]') / length(s))) AS INT)", 4),
    "different": ("CAST(least(3, floor(size(array_distinct(split(left(s, 64), ''))) / 5)) AS INT)", 4),
    "changes": ("CASE WHEN regexp_count(s, '[0-9][A-Za-z]|[A-Za-z][0-9]') = 0 THEN 0 WHEN 8 * regexp_count(s, '[0-9][A-Za-z]|[A-Za-z][0-9]') < length(s) THEN 1 ELSE 2 END", 3),
    "case": (r"CASE WHEN s RLIKE '\\p{Ll}' AND s RLIKE '\\p{Lu}' THEN 2 WHEN s RLIKE '\\p{Lu}' THEN 1 ELSE 0 END", 3),
    "cue": ("CAST(c RLIKE '(?:token|secret|passw|key|tel|phone|call|fax|mobile|handy|ssn|social|name|mr|mrs|ms|dr|herr|frau|señor|madame|monsieur)' AS INT)", 2),
    "before": (r"CASE WHEN c RLIKE '[=:][\\x20\'\"]*$' THEN 2 WHEN c RLIKE '[\'\"(]$' THEN 1 ELSE 0 END", 3),
    "after": (r"CAST(coalesce(a, '') RLIKE '[\'\",;)]' AS INT)", 2),
}
#: The votes' and bins' patterns of a kind: no more than three labelers vote on one, with two values each, beside the bins.
PATTERNS_AT_MOST = 2**3 * 5 * 4 * 4 * 3 * 3 * 2 * 3 * 2
THRESHOLD = 0.5
EM_ROUNDS = 50


def spans_of(text: Column, pattern: str, valid=lambda s: F.lit(True)) -> Column:
    """The valid matches of a pattern as structs (s, b, e): the pieces between the matches give their places."""
    pieces = F.split(text, pattern)
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    both = F.struct(pieces.alias("p"), found.alias("m"))

    def place(x: Column) -> Column:
        # the sum of lengths so far, carried along with the spans
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:string,b:int,e:int>>").alias("out"))
        return F.aggregate(
            F.arrays_zip(F.slice(x["p"], 1, F.size(x["m"])).alias("p"), x["m"].alias("m")),
            start,
            lambda acc, pair: F.struct(
                (acc["at"] + F.length(pair["p"]) + F.length(pair["m"])).alias("at"),
                F.when(
                    valid(pair["m"]),
                    F.concat(acc["out"], F.array(F.struct(pair["m"].alias("s"), (acc["at"] + F.length(pair["p"])).alias("b"), (acc["at"] + F.length(pair["p"]) + F.length(pair["m"])).alias("e")))),
                )
                .otherwise(acc["out"])
                .alias("out"),
            ),
            lambda acc: acc["out"],
        )

    empty = F.array().cast("array<struct<s:string,b:int,e:int>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), let(both, place)).otherwise(empty)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    def value(i: Column) -> Column:
        d = F.ascii(digits.substr(n - i, F.lit(1))) - 48
        twice = 2 * d
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + value(i))
    return total % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return s.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    digits = F.regexp_replace(s, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    return spans_of(text, PATTERNS[kind], lambda s: _valid(kind, s))


def _of_kind(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(F.lit(kind).alias("kind"), x["b"].alias("b"), x["e"].alias("e"), x["s"].alias("s")))


def _counter(kind: str):
    return lambda n, x: n + F.when(x["kind"] == kind, 1).otherwise(0)


def candidates(found: DataFrame) -> DataFrame:
    """_key, kind, b, e, s, the votes v_<labeler> and the bins f_<feature> of every candidate that overlaps no base span.

    found has _key, the text and base (all base spans of the row)."""
    each = [_of_kind(k, spans_of(F.col("_text"), p)) for k, p in EXTRA.items()]
    rows = found.select("_key", "_text", "base", F.explode(F.concat(*each)).alias("x"))
    rows = rows.where(~F.exists("base", lambda y: (y["b"] < F.col("x.e")) & (F.col("x.b") < y["e"])))
    start = F.greatest(F.col("x.b") - CONTEXT, F.lit(0))
    rows = rows.select("_key", "x.*", F.lower(F.col("_text").substr(start + 1, F.col("x.b") - start)).alias("c"), F.col("_text").substr(F.col("x.e") + 1, F.lit(1)).alias("a"))
    return rows.select("_key", "kind", "b", "e", "s", *[F.expr(v).alias(f"v_{n}") for n, v in LABELERS.items()], *[F.expr(v).alias(f"f_{n}") for n, (v, _) in FEATURES.items()])


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], prior: float = 0.5, rounds: int = EM_ROUNDS) -> tuple[dict[tuple[int, ...], float], list[tuple[float, float]], float]:
    """Posteriors of the vote patterns, (rate of votes for among positives, among negatives) of each labeler, and the share of positives.

    Each labeler errs independently given the truth. The rates begin at 0.8 and 0.2, so positives are what most votes are for."""
    k = len(patterns[0][0]) if patterns else 0
    rates, total = [(0.8, 0.2)] * k, sum(n for _, n in patterns)
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes, _n in patterns:
            log = math.log(prior / (1 - prior))
            for v, (p, q) in zip(votes, rates, strict=True):
                log += math.log(p / q) if v > 0 else math.log((1 - p) / (1 - q)) if v < 0 else 0.0
            post[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
        # a beta prior of ten votes at the starting rates keeps rare labelers from flipping their sense
        for j in range(k):
            pos = [(n * post[v], v[j] > 0) for v, n in patterns if v[j]]
            neg = [(n * (1 - post[v]), v[j] > 0) for v, n in patterns if v[j]]
            p = (8 + sum(w for w, y in pos if y)) / (10 + sum(w for w, _ in pos))
            q = (2 + sum(w for w, y in neg if y)) / (10 + sum(w for w, _ in neg))
            rates[j] = (max(p, q, 0.01), min(p, q, 0.99)) if p != q else (p + 0.01, q)
            rates[j] = tuple(min(0.99, max(0.01, x)) for x in rates[j])
        prior = min(0.99, max(0.01, (1 + sum(n * post[v] for v, n in patterns)) / (2 + total)))
    return post, rates, prior


def logistic(rows: list[tuple[tuple[float, ...], float, float]], rounds: int = 300, ridge: float = 1e-2) -> list[float]:
    """Weights (the bias last) of a logistic model of (features, soft label, weight), by gradient steps."""
    if not rows:
        return [0.0]
    k, total = len(rows[0][0]), sum(w for *_, w in rows)
    weights = [0.0] * (k + 1)
    for step in range(rounds):
        grad = [ridge * x for x in weights[:-1]] + [0.0]
        for x, y, w in rows:
            z = weights[-1] + sum(a * b for a, b in zip(weights, x, strict=False))
            d = w / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y)
            for j in range(k):
                grad[j] += d * x[j]
            grad[k] += d
        weights = [a - 2.0 * b for a, b in zip(weights, grad, strict=True)]
    return weights


def train(cands: DataFrame) -> dict[str, dict]:
    """The classifier of each kind from all candidates: a weight for each bin of each feature, and a bias."""
    votes, bins = [f"v_{n}" for n in LABELERS], [f"f_{n}" for n in FEATURES]
    counted = [r.asDict() for r in cands.groupBy("kind", *votes, *bins).count().collect()]  # one row a pattern
    places = [(f"f_{n}", k) for n, (_, size) in FEATURES.items() for k in range(size)]
    out = {}
    for kind in EXTRA:
        patterns: dict[tuple[int, ...], int] = {}
        shapes: dict[tuple[int, ...], dict[tuple[int, ...], int]] = {}
        for r in counted:
            if r["kind"] == kind:
                v, x = tuple(r[n] for n in votes), tuple(r[n] for n in bins)
                patterns[v] = patterns.get(v, 0) + r["count"]
                shapes.setdefault(x, {})
                shapes[x][v] = shapes[x].get(v, 0) + r["count"]
        if not patterns:
            continue
        post, _, _ = expectation_maximisation(sorted(patterns.items()))
        rows = []
        for x, by in sorted(shapes.items()):
            n = sum(by.values())
            rows.append((tuple(float(x[bins.index(f)] == k) for f, k in places), sum(c * post[v] for v, c in by.items()) / n, float(n)))
        fitted = logistic(rows)
        out[kind] = {"bias": fitted[-1], "weights": dict(zip(places, fitted[:-1], strict=True))}
    return out


def _score(model: dict[str, dict]) -> Column:
    """The likelihood of a candidate by the model of its kind."""
    z = F.lit(-30.0)
    for kind, fitted in model.items():
        own = F.lit(fitted["bias"])
        for n, (_, size) in FEATURES.items():
            own = own + F.element_at(F.array(*[F.lit(fitted["weights"][f"f_{n}", k]) for k in range(size)]), F.col(f"f_{n}") + 1)
        z = F.when(F.col("kind") == kind, own).otherwise(z)
    return 1 / (1 + F.exp(-z))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, base (structs kind, b, e, s in order of kind as listed, then start) and added (likewise, with score) of each row."""
    named = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    each = [_of_kind(k, base_spans(F.col("_text"), k)) for k in KINDS]
    spotted = named.select(F.xxhash64("_id", "_text").alias("_hash"), "_id", "_text", F.concat(*each).alias("base"))
    every = F.array_compact(F.array(*[F.when(F.regexp_like("_text", F.lit(p)), F.lit(k)) for k, p in EXTRA.items()]))
    spotted = stored(spotted.select(F.struct("_id", "_hash").alias("_key"), "base", F.when(F.size(every) > 0, F.col("_text")).alias("_text")))
    cands = candidates(spotted.where("_text IS NOT NULL"))
    model = train(cands)
    likely = cands.withColumn("score", _score(model)).where(F.col("score") >= threshold)
    order = F.array(*[F.lit(k) for k in EXTRA])
    added = likely.groupBy("_key").agg(F.array_sort(F.collect_set(F.struct((F.array_position(order, F.col("kind"))).alias("rank"), "b", "e", "kind", "s", "score"))).alias("added"))
    out = spotted.select("_key", "base").join(added.withColumnRenamed("_key", "_k"), F.col("_key").eqNullSafe(F.col("_k")), "left")
    none = F.array().cast(added.schema["added"].dataType)
    return out.select(F.col("_key._id").alias(id_col), "base", F.coalesce("added", none).alias("added"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["b"].cast("string"), x["e"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns asked for, and n_spans: base spans and added ones."""
    out = find(read(spark, sf_dir, "documents"))
    counts = [F.aggregate("base", F.lit(0).cast("long"), _counter(k)).alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), F.concat_ws(",", F.nullif(_joined(F.col("base")), F.lit("")), F.nullif(_joined(F.col("added")), F.lit(""))).alias("spans"), (F.size("base") + F.size("added")).cast("long").alias("n_spans"))
