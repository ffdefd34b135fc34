"""Repeated byte strings of a given length, by prefix-free parsing of the corpus.

Parsing: a rolling hash over a quarter of LENGTH is taken at every place; each LENGTH-byte string has one trigger, the
leftmost gram of least hash inside it, which depends on the string's bytes alone. The string starts that share a
trigger are consecutive and make a phrase (the bytes they cover), so a text is a parse of overlapping phrases and
equal strings lie in phrases of equal trigger, at equal distances from it.

Dictionary and parse: the distinct phrases, by a 128-bit digest of their bytes, with how often the parse holds each. In a phrase
that stands twice, every start repeats; a phrase whose trigger stands nowhere else has none. Only where different
phrases share a trigger is the order within them needed. The dictionary is dealt into partitions by trigger, and in
each the suffix array of its phrases is built by doubling prefixes: suffixes of LENGTH bytes that are neighbours in that
order and have the same rank are equal, byte for byte. As phrases overlap by LENGTH - 1 bytes, the parse has to be
looked up to a depth of one phrase only: corpus order to a depth of LENGTH is that of the dictionary, each phrase as often
as the parse has it.

A trigger with more than MOST_PHRASES different phrases is too much for one partition. Its phrases are compared in blocks of
starts and, where these leave it open, start by start, by fingerprints of 64 bits beside the trigger's 64, which can be
counted in parts, so that no trigger, however frequent, is brought into one task.

Edge cases: a null text is empty. A text shorter than LENGTH has nothing removed. Equal rows repeat each
other and lose all strings; rows of one id and other texts, and rows without id, count as rows of their own. Columns of the
input may have any names: only id and text are read, under names of our own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import id_of, key_of, read, stored
from lexiloom.session import released

LENGTH = 400
#: A trigger is a gram of this part of a string.
GRAMS = 4
#: Triggers are sought for so many starts at a time; a text's fingerprints take some 40 bytes a byte meanwhile.
BLOCK = 1 << 20
#: Phrases of a partition of the dictionary, about, and the most that share a trigger there.
PART_PHRASES, MOST_PHRASES = 250, 2000
#: Starts of phrases that share a more frequent trigger are compared in blocks of so many before they are compared one by one.
BLOCK_STARTS = 8
_RNG = np.random.default_rng(20240302)
_TABLE = _RNG.integers(0, 1 << 63, 256, dtype="u8") * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_POWERS: dict[int, np.ndarray] = {}
#: Bytes of a phrase's digest.
DIGEST = 16


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse modulo 2^64, n at least."""
    if len(_POWERS.get(0, ())) < n:
        n = max(n, 1 << 15)
        for k, base in ((0, _BASE), (1, pow(_BASE, -1, 1 << 64))):
            p = np.full(n, base, "u8")
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class Hashed:
    """Fingerprints of any substring of some bytes, from one prefix sum."""

    def __init__(self, data: bytes | np.ndarray):
        raw = np.frombuffer(data, "u1") if isinstance(data, bytes) else data
        up, self.down = _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, "u8")
        np.cumsum(_TABLE[raw] * up[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def triggers(grams: np.ndarray, width: int) -> np.ndarray:
    """For each start, the leftmost place of the least gram among `width` places from it."""
    n = len(grams) - width + 1
    key = (grams & ~np.uint64((1 << 22) - 1)) | np.arange(len(grams), dtype="u8")
    rows = -(-len(key) // width)
    padded = np.full(rows * width, ~np.uint64(0), "u8")
    padded[: len(key)] = key
    padded = padded.reshape(rows, width)
    before = np.minimum.accumulate(padded, 1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return (np.minimum(after[:n], before[width - 1 : width - 1 + n]) & np.uint64((1 << 22) - 1)).astype("i8")


def phrases(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """first start, last start, trigger hash and place of the trigger in each phrase, and the digests of the phrases end to end."""
    raw, gram = np.frombuffer(text, "u1"), max(1, length // GRAMS)
    if len(raw) < length:
        return (*(np.zeros(0, "i8") for _ in range(4)), b"")
    hashed = Hashed(raw)
    grams, width = hashed.all(gram), length - gram + 1
    where = np.concatenate([triggers(grams[at : at + BLOCK + width - 1], width) + at for at in range(0, len(raw) - length + 1, BLOCK)])
    cut_ = np.flatnonzero(np.diff(where)) + 1
    first, last = np.concatenate(([0], cut_)), np.concatenate((cut_ - 1, [len(where) - 1]))
    trigger = where[first]
    # where the trigger stands in the phrase is part of what makes two phrases equal
    lead = trigger - first
    digests = [hashlib.blake2b(text[x:y], digest_size=DIGEST, salt=z.to_bytes(8, "little")).digest() for x, y, z in zip(first.tolist(), (last + length).tolist(), lead.tolist(), strict=True)]
    return first, last, grams[trigger], lead, b"".join(digests)


def _lists(parts: list[np.ndarray], kind: str) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends.astype("i4")), pa.array(np.concatenate([np.zeros(0, kind), *[p.view(kind) if p.dtype.itemsize == np.dtype(kind).itemsize else p.astype(kind) for p in parts]])))


def _digest_lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // DIGEST for p in parts)]).astype("i4")
    values = pa.Array.from_buffers(pa.binary(), int(ends[-1]), [None, pa.py_buffer((np.arange(ends[-1] + 1) * DIGEST).astype("i4")), pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends), values)


def parse(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """_id, _mark (hash of the text), n_bytes, sha and the phrases of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                raw = [(t.as_py() or "").encode() for t in part.column(2)]
                found = [phrases(b, length) for b in raw]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(b) for b in raw], pa.int64()), pa.array([hashlib.sha256(b).hexdigest() for b in raw], pa.string()), *[_lists([f[k] for f in found], t) for k, t in enumerate(("i4", "i4", "i8", "i4"))], _digest_lists([f[4] for f in found])],
                    names=["_id", "_mark", "n_bytes", "sha", "first", "last", "trigger", "lead", "phrase"],
                )

    rows = docs.select(key_of(docs, id_col).alias("_id"), F.xxhash64(text_col), F.col(text_col))
    return rows.mapInArrow(run, f"_id {kind}, _mark long, n_bytes long, sha string, first array<int>, last array<int>, trigger array<long>, lead array<int>, phrase array<binary>")


def _ranked(key: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones."""
    order = np.argsort(key)
    at = key[order]
    out = np.empty(len(key), "u8")
    out[order] = np.cumsum(np.concatenate(([False], at[1:] != at[:-1])))
    return out


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """The rank of each suffix of data (bytes) in the order of its first `length` bytes: equal ranks, equal bytes. Past the end stand zeros."""

    def after(x: np.ndarray, n: int) -> np.ndarray:
        return np.concatenate((x[n:], np.zeros(min(n, len(x)), x.dtype)))

    depth, key = min(8, length), np.zeros(len(data), "u8")
    for k in range(depth):
        key = (key << np.uint64(8)) | after(data, k).astype("u8")
    rank = _ranked(key)
    while depth < length:
        step = min(depth, length - depth)
        rank = _ranked((rank << np.uint64(32)) | after(rank, step))
        depth += step
    return rank


def repeated(phrases_: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each phrase, the runs (first, last) of starts whose `length` bytes start elsewhere in these phrases too."""
    sizes = np.array([len(p) for p in phrases_], "i8")
    ends = np.cumsum(sizes)
    rank = suffix_ranks(np.frombuffer(b"".join(phrases_), "u1"), length)
    starts = sizes - length + 1
    which = np.repeat(np.arange(len(sizes)), starts)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(starts) - starts, starts)
    own = rank[(ends - sizes)[which] + inside]
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    opens = twice & np.concatenate(([True], ~twice[:-1] | (which[1:] != which[:-1])))
    shuts = twice & np.concatenate((~twice[1:] | (which[1:] != which[:-1]), [True]))
    out: list[list[tuple[int, int]]] = [[] for _ in phrases_]
    for k, a, b in zip(which[opens].tolist(), inside[opens].tolist(), inside[shuts].tolist(), strict=True):
        out[k].append((a, b))
    return out


def _bytes_of(texts: DataFrame, kind: str, length: int) -> DataFrame:
    """_id, _mark, first, trigger, alone and bytes of each listed phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cols, pieces, size = [], [[], [], []], [], 0
            for i in range(batch.num_rows):
                raw, values = (batch.column(2)[i].as_py() or "").encode(), batch.column(3)[i].values
                first, last, trigger, alone = (values.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                at += [i] * len(first)
                for col, x in zip(cols, (first, trigger, alone), strict=True):
                    col.append(x)
                pieces += [raw[a : b + length] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                size += len(raw)
                if size > 4_000_000 or i + 1 == batch.num_rows:
                    rows = pa.array(at, pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *[pa.array(np.concatenate(c)) for c in cols], pa.array(pieces, pa.binary())], names=["_id", "_mark", "first", "trigger", "alone", "bytes"])
                    at, cols, pieces, size = [], [[], [], []], [], 0

    return texts.select("_id", "_mark", "_text", "_phrases").mapInArrow(run, f"_id {kind}, _mark long, first int, trigger long, alone boolean, bytes binary")


def _ordered(rows: DataFrame, kind: str, length: int) -> DataFrame:
    """_id, _mark, first and last of the repeated starts of phrases that stand once; rows are those of _bytes_of() with their part."""

    def run(part: pa.Table) -> pa.Table:
        found = repeated(part["bytes"].to_pylist(), length)
        alone, first = part["alone"].to_pylist(), part["first"].to_pylist()
        each = [(i, first[i] + a, first[i] + b) for i, runs in enumerate(found) if alone[i] for a, b in runs]
        rows_ = pa.array([e[0] for e in each], pa.int64())
        return pa.table([part["_id"].take(rows_), part["_mark"].take(rows_), pa.array([e[1] for e in each], pa.int32()), pa.array([e[2] for e in each], pa.int32())], names=["_id", "_mark", "first", "last"])

    return rows.groupBy("part").applyInArrow(run, f"_id {kind}, _mark long, first int, last int")


def _blocks(texts: DataFrame, length: int) -> DataFrame:
    """trigger, core, whole, uid, at and alone of each block of the listed phrases.

    A block is BLOCK_STARTS starts at aligned distances from the trigger, also past the phrase's own. Its core is
    what all its strings have in common, its whole what they cover; where the whole leaves the text it is made
    a fingerprint that no other block has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, size = [], 0
            for i in range(batch.num_rows):
                hashed = Hashed((batch.column(0)[i].as_py() or "").encode())
                n = len(hashed.sums) - 1
                values = batch.column(1)[i].values
                first, last, lead, trigger, uid, alone = (values.field(k).to_numpy(zero_copy_only=False) for k in range(6))
                place = first.astype("i8") + lead
                low, high = (place - last) // BLOCK_STARTS, lead // BLOCK_STARTS
                count = high - low + 1
                which = np.repeat(np.arange(len(count)), count)
                k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which]
                to = place[which] - k * BLOCK_STARTS
                at = to - BLOCK_STARTS + 1
                tag = _mix(k.astype("u8") + _M1)
                core = _mix(hashed.of(to, at + length) ^ tag)
                inside = (at >= 0) & (to + length <= n)
                whole = _mix(uid[which].astype("u8") * _M2 ^ tag)
                whole[inside] = _mix(hashed.of(at[inside], to[inside] + length) ^ tag[inside])
                made.append((trigger[which], core.view("i8"), whole.view("i8"), uid[which], at.astype("i4"), alone[which]))
                size += len(at)
                if size > 200_000 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*made, strict=True)], names=["trigger", "core", "whole", "uid", "at", "alone"])
                    made, size = [], 0

    return texts.select("_text", "_phrases").mapInArrow(run, "trigger long, core long, whole long, uid long, at int, alone boolean")


def _starts(texts: DataFrame, length: int) -> DataFrame:
    """trigger, string, uid, at and alone of each start of the listed blocks; string tells the start's distance from the trigger too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, size = [], 0
            for i in range(batch.num_rows):
                hashed = Hashed((batch.column(0)[i].as_py() or "").encode())
                values = batch.column(1)[i].values
                at, place, trigger, uid, alone = (values.field(k).to_numpy(zero_copy_only=False) for k in range(5))
                which = np.repeat(np.arange(len(at)), BLOCK_STARTS)
                start = at.astype("i8")[which] + np.tile(np.arange(BLOCK_STARTS), len(at))
                fits = (start >= 0) & (start + length < len(hashed.sums))
                which, start = which[fits], start[fits]
                string = _mix(hashed.of(start, start + length) ^ _mix((place[which] - start).astype("u8") + _M2))
                made.append((trigger[which], string.view("i8"), uid[which], start.astype("i4"), alone[which]))
                size += len(start)
                if size > 200_000 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*made, strict=True)], names=["trigger", "string", "uid", "at", "alone"])
                    made, size = [], 0

    return texts.select("_text", "_blocks").mapInArrow(run, "trigger long, string long, uid long, at int, alone boolean")


def cut(text: bytes, firsts: np.ndarray, lasts: np.ndarray, length: int = LENGTH) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left, for ranges of repeated starts."""
    edge = np.zeros(len(text) + 1, "i8")
    np.add.at(edge, firsts, 1)
    np.add.at(edge, lasts + length, -1)
    gone = np.cumsum(edge)[:-1] > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return int(gone.sum()), spans, np.frombuffer(text, "u1")[~gone].tobytes()


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes left, null where nothing is removed) of each row."""
    parsed = stored(parse(docs, id_col, text_col, length))
    rows = parsed.select("_id", "_mark", F.explode(F.arrays_zip("first", "last", "trigger", "phrase", "lead")).alias("p")).select("_id", "_mark", "p.*")
    # what a join looks up in is stored first where it comes of the same rows: the join then has an exchange of its own
    # for the rows, in which a frequent trigger can be split
    often = stored(rows.groupBy("trigger").agg(F.count("*").alias("n")).where("n > 1").select("trigger"))
    shared = stored(rows.join(often, "trigger", "left_semi"))
    released(often)
    # only texts that share a trigger are fetched, once
    ids = shared.select("_id", "_mark").distinct()
    named = docs.select(key_of(docs, id_col).alias("_id"), F.xxhash64(text_col).alias("_mark"), F.col(text_col).alias("_text"))
    texts = stored(named.join(ids.hint("shuffle_hash"), ["_id", "_mark"], "left_semi").dropDuplicates(["_id", "_mark"]))
    # phrases as wholes
    dictionary = stored(shared.groupBy("trigger", "phrase").agg(F.count("*").alias("n"), F.min(F.struct("_id", "_mark", "first", "last", "lead")).alias("one")))
    mixed = stored(dictionary.groupBy("trigger").agg(F.count("*").alias("k"), F.min("n").alias("least")).where("k > 1 AND least = 1").select("trigger", "k"))
    unclear = dictionary.join(mixed, "trigger").select("one.*", "trigger", "k", F.monotonically_increasing_id().alias("uid"), (F.col("n") == 1).alias("alone"))
    unclear = stored(unclear)
    released(mixed)
    kind = docs.schema[id_col].dataType.simpleString()
    # suffix arrays, where a partition of the dictionary can hold the trigger
    few = unclear.where(F.col("k") <= MOST_PHRASES)
    parts = max(1, few.count() // PART_PHRASES)
    lists = few.groupBy("_id", "_mark").agg(F.collect_list(F.struct("first", "last", "trigger", "alone")).alias("_phrases"))
    pieces = _bytes_of(texts.join(lists.hint("shuffle_hash"), ["_id", "_mark"]), kind, length)
    # stored, so that its exchange, which cannot be split, stands in no stage with those that can
    ordered = stored(_ordered(pieces.withColumn("part", F.pmod(F.xxhash64("trigger"), F.lit(parts))), kind, length))
    unclear = unclear.where(F.col("k") > MOST_PHRASES)
    # blocks: one that stands twice repeats at every start, one whose core stands alone at none
    lists = unclear.groupBy("_id", "_mark").agg(F.collect_list(F.struct("first", "last", "lead", "trigger", "uid", "alone")).alias("_phrases"))
    blocks = stored(_blocks(texts.join(lists.hint("shuffle_hash"), ["_id", "_mark"]), length))
    met = stored(blocks.groupBy("trigger", "core").agg(F.count("*").alias("n"), F.max("alone").alias("any_alone")).where("n > 1 AND any_alone").select("trigger", "core"))
    all_blocks, blocks = blocks, stored(blocks.join(met, ["trigger", "core"], "left_semi"))
    released(all_blocks, met)
    kinds = stored(blocks.groupBy("trigger", "core", "whole").agg(F.count("*").alias("n"), F.min(F.struct("alone", "uid", "at")).alias("one")))
    several = stored(kinds.groupBy("trigger", "core").agg(F.count("*").alias("k")).where("k > 1").select("trigger", "core"))
    open_ = kinds.join(several, ["trigger", "core"], "left_semi").select("one.uid", "one.at", ((F.col("n") == 1) & F.col("one.alone")).alias("alone"))
    # starts of the blocks that are left
    phrase = unclear.select("uid", "_id", "_mark", "trigger", (F.col("first") + F.col("lead")).alias("place"))
    lists = open_.join(phrase, "uid").groupBy("_id", "_mark").agg(F.collect_list(F.struct("at", "place", "trigger", "uid", "alone")).alias("_blocks"))
    starts = stored(_starts(texts.join(lists.hint("shuffle_hash"), ["_id", "_mark"]), length))
    released(several)
    twice = stored(starts.groupBy("trigger", "string").agg(F.count("*").alias("n"), F.max("alone").alias("any_alone")).where("n > 1 AND any_alone").select("trigger", "string"))
    single = starts.where("alone").join(twice, ["trigger", "string"], "left_semi").select("uid", F.col("at").alias("first"), F.col("at").alias("last"))
    block = blocks.where("alone").join(kinds.where("n > 1").select("trigger", "core", "whole"), ["trigger", "core", "whole"], "left_semi").select("uid", F.col("at").alias("first"), (F.col("at") + BLOCK_STARTS - 1).alias("last"))
    found = block.unionByName(single).join(phrase, "uid").select("_id", "_mark", "first", "last")
    whole = shared.join(dictionary.where("n > 1").select("trigger", "phrase"), ["trigger", "phrase"], "left_semi").select("_id", "_mark", "first", "last")
    ranges = whole.unionByName(found).unionByName(ordered).groupBy("_id", "_mark").agg(F.collect_set(F.struct("first", "last")).alias("_ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                values = batch.column(3)[i].values
                out.append(cut((batch.column(2)[i].as_py() or "").encode(), values.field(0).to_numpy().astype("i8"), values.field(1).to_numpy().astype("i8"), length))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([hashlib.sha256(o[2]).hexdigest() for o in out], pa.string()), pa.array([o[2] for o in out], pa.binary())],
                names=["_i", "_m", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    changed = texts.join(ranges.hint("shuffle_hash"), ["_id", "_mark"]).select("_id", "_mark", "_text", "_ranges").mapInArrow(run, f"_i {kind}, _m long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    joined = parsed.select("_id", "_mark", "n_bytes", "sha").join(changed, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(id_of(docs, F.col("_id"), id_col).alias("_id"), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents")).drop("kept").withColumnRenamed("_id", "doc_id")


#: The query by brute force: every string of LENGTH bytes, in hexadecimal, counted by its md5. Texts are cut in overlapping
#: stretches first, so that taking a string is cheap.
ORACLE = f"""WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
    stretch AS (SELECT doc_id, n, k * 1000 AS base, substring(x, 2 * k * 1000 + 1, 2 * (999 + {LENGTH})) AS y FROM (SELECT *, unnest(range(0, n // 1000 + 1)) AS k FROM h)),
    starts AS (SELECT doc_id, base + i AS a, md5(substring(y, 2 * i + 1, {2 * LENGTH})) AS g FROM (SELECT *, unnest(range(0, least(1000, n - {LENGTH - 1} - base))) AS i FROM stretch WHERE n - {LENGTH - 1} > base)),
    hit AS (SELECT doc_id, a FROM starts WHERE g IN (SELECT g FROM starts GROUP BY g HAVING count(*) > 1)),
    flagged AS (SELECT doc_id, a, coalesce(a - lag(a) OVER (PARTITION BY doc_id ORDER BY a) > {LENGTH}, true)::INTEGER AS fresh FROM hit),
    numbered AS (SELECT doc_id, a, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a) AS k FROM flagged),
    spans AS (SELECT doc_id, min(a) AS lo, max(a) + {LENGTH} AS hi FROM numbered GROUP BY doc_id, k),
    gaps AS (SELECT doc_id, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS f, lo AS t FROM spans UNION ALL SELECT doc_id, max(hi), max(n) FROM spans JOIN h USING (doc_id) GROUP BY 1),
    kept AS (SELECT doc_id, string_agg(substring(x, (2 * f + 1)::BIGINT, (2 * (t - f))::BIGINT), '' ORDER BY f) AS k FROM gaps JOIN h USING (doc_id) GROUP BY 1),
    gone AS (SELECT doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans FROM spans GROUP BY 1)
    SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(from_hex(coalesce(k, x))) AS kept_sha256
    FROM h LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""
