"""Near-duplicate documents: b-bit MinHash signatures joined by a multi-index Hamming search, confirmed on full sets.

A signature has CHUNKS * WIDTH symbols of 16 bits. Two signatures that differ in at most CHUNKS * 2 - 1 symbols
agree, by pigeonhole, in some chunk up to one symbol; so each chunk is entered once for each symbol left out,
and every pair within that distance meets in an entry. (At the similarity of 0.85, all chunks of a pair
differ in two symbols or more with a probability of 6e-7.) Candidates, also those beyond the
distance, are confirmed by comparing whole shingle sets, unless their sketches rule them out for certain.

Documents of equal sets are one node, the class, so copies never meet in pairs. In an entry, nodes meet a pivot that
the entry's hash chooses; then classes that are not yet connected meet across components. So no link
between different texts is lost, and the pairs inside a connected group are not listed.

Where they meet across components, a pair comes out of the first entry that it shares, and only if two sketches let it:
one of fixed size, and one in proportion to the set, whose parities tell nearly how many shingles differ. So what
comes out of an entry are pairs that are linked, or within a few shingles of it, not all that meet there.

Edge cases: a null, empty or blank text has an empty set and is linked with nothing; a text of fewer words than a
shingle has its whole sequence as one shingle. Repeated rows belong to one class. Ids that repeat with other
texts, and null ids, count as rows of their own. Columns of the input may have any names: only id and text are read,
under names of our own. An empty table gives no rows. Sets are of 64-bit fingerprints of shingles; classes of 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import read, stored
from lexiloom.llm.components import components
from lexiloom.llm.substring_dedup import Hashed
from lexiloom.session import released

CHUNKS, WIDTH = 8, 5
SYMBOLS = CHUNKS * WIDTH
#: log2 of the bits of a set's short sketch. A long one has LONG_FACTOR bits a shingle at least, in a power of two.
SKETCH_BITS = 9
LONG_FACTOR = 3
_RNG = np.random.default_rng(20240301)
_A = _RNG.integers(0, 1 << 31, (SYMBOLS, 1), dtype="u4") * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, (SYMBOLS, 1), dtype="u4")
_M1, _M2, _M3 = (np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15))


#: Words are hashed in stretches of so many bytes, so that a very long text takes no more memory for it.
STRETCH = 1 << 20
#: Longer words are hashed one by one.
LONG_WORD = 256
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit fingerprints of the words of a text, in order."""
    raw = np.frombuffer(text, "u1")
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _IS_SPACE[raw], [True]))))
    starts, ends = edges[::2], edges[1::2]
    out, at = np.empty(len(starts), "u8"), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + STRETCH, "right")))
        if ends[to - 1] - starts[at] <= STRETCH:
            low = starts[at]
            out[at:to] = Hashed(raw[low : ends[to - 1]]).of(starts[at:to] - low, ends[at:to] - low)
        at = to
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(text[starts[i] : ends[i]])
    return out


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct fingerprints of the text's shingles of `size` words."""
    h = word_hashes((text or "").encode().lower())  # bytes: A-Z are lowered and ASCII white space splits, nothing else
    if not len(h):
        return h
    n = min(size, len(h))
    x = np.full(len(h) - n + 1, n * int(_M3) & (1 << 64) - 1, "u8")
    for k in range(n):
        x = _mix(x ^ h[k : k + len(x)]) + _M3
    x.sort()
    return x[np.concatenate(([True], x[1:] != x[:-1]))]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The lowest 16 bits of the least value under each of SYMBOLS hashes, which multiply the high half of a fingerprint."""
    least, x = np.full(SYMBOLS, 0xFFFFFFFF, "u4"), (shingles >> np.uint64(32)).astype("u4")
    for at in range(0, len(x), 1024):
        block = _A * x[at : at + 1024]
        block += _B
        least = np.minimum(least, block.min(1))
    return (least & np.uint32(0xFFFF)).astype("u8")


def entries(symbols: np.ndarray) -> np.ndarray:
    """The index entries of each signature (the last axis): for each chunk and each symbol of it left out, the others."""
    parts = symbols.reshape(*symbols.shape[:-1], CHUNKS, WIDTH)
    out = np.zeros(parts.shape, "u8")
    for skip in range(WIDTH):
        for k in range(WIDTH):
            if k != skip:
                out[..., skip] = _mix((out[..., skip] << np.uint64(16)) + out[..., skip] * _M3 + parts[..., k] + np.uint64(k + 1))
    tag = np.arange(SYMBOLS, dtype="u8").reshape(CHUNKS, WIDTH)
    return _mix(out + tag * _M3).reshape(symbols.shape)


def _entries_of(sigs: pa.Array) -> np.ndarray:
    """entries() of a column of signatures, as rows of signed numbers."""
    flat = np.frombuffer(b"".join(s.as_py() for s in sigs), "<u2").astype("u8")
    return entries(flat.reshape(len(sigs), SYMBOLS)).view("i8")


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity of how many shingles fall on each of SKETCH * 64 bits. Two sets' sketches differ in no more
    bits than the sets have members that the other lacks, so many differing bits rule a pair out for certain."""
    bits = np.bincount(_mix(shingles * _M3) >> np.uint64(64 - SKETCH_BITS), minlength=1 << SKETCH_BITS) & 1
    return np.packbits(bits.astype("u1"), bitorder="little").view("<i8")


def long_sketch(shingles: np.ndarray) -> np.ndarray:
    """As sketch(), with LONG_FACTOR bits or more for each shingle. Places are the low bits of a hash, so the two halves of a
    sketch combine by exclusive or into the sketch of half the bits."""
    bits = max(6, int(LONG_FACTOR * len(shingles) - 1).bit_length())
    odd = np.bincount((_mix(shingles * _M1 + _M3) & np.uint64((1 << bits) - 1)).astype("i8"), minlength=1 << bits) & 1
    return np.packbits(odd.astype("u1"), bitorder="little").view("<i8")


def class_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def features(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """_id, _mark (hash of the text), n_shingles, node (null for an empty set), signature and sketch of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, sig, odd = [], [], [], []
            for text in batch.column(2):
                s = shingle_set(text.as_py(), size)
                n.append(len(s))
                node.append(class_of(s) if len(s) else None)
                sig.append(signature(s).astype("<u2").tobytes() if len(s) else None)
                odd.append(sketch(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary()), pa.array(odd, pa.list_(pa.int64()))], names=["_id", "_mark", "n_shingles", "node", "sig", "odd"])

    return docs.select(F.col(id_col), F.xxhash64(text_col), F.col(text_col)).mapInArrow(run, f"_id {kind}, _mark long, n_shingles long, node binary, sig binary, odd array<long>")


def index(nodes: DataFrame) -> DataFrame:
    """entry, node: a row for each entry of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _entries_of(batch.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), batch.column(0).take(pa.array(np.repeat(np.arange(len(keys)), SYMBOLS)))], names=["entry", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "entry long, node binary")


def _possible(per_cent: int) -> str:
    """Whether sets a and b can be alike: their sizes are near, and their sketches differ in few enough bits."""
    bits = " + ".join(f"bit_count(oa[{k}] ^ ob[{k}])" for k in range((1 << SKETCH_BITS) // 64))
    return f"100 * least(na, nb) >= {per_cent} * greatest(na, nb) AND {100 + per_cent} * ({bits}) <= {100 - per_cent} * (na + nb)"


def _differ(a: str, b: str) -> str:
    """In how many bits the long sketches a and b differ; the longer one is folded (sizes that are near differ by a factor of two at most)."""

    def folded(x: str, y: str) -> str:
        return f"if(size({x}) > size({y}), zip_with(slice({x}, 1, size({y})), slice({x}, size({y}) + 1, size({y})), (p, q) -> p ^ q), {x})"

    return f"aggregate(zip_with({folded(a, b)}, {folded(b, a)}, (p, q) -> bit_count(p ^ q)), 0, (n, d) -> n + d)"


def _met(sets: DataFrame, sigs: DataFrame) -> DataFrame:
    """node, long (sketch) and entries of the nodes of sigs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                longs = [long_sketch(np.frombuffer(x.as_buffer(), "<u8")) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(longs, pa.list_(pa.int64())), pa.array(list(_entries_of(part.column(2))), pa.list_(pa.int64()))], names=["node", "long", "entries"])

    return sets.join(sigs, "node").select("node", "set", "sig").mapInArrow(run, "node binary, long array<long>, entries array<long>")


def _side(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("odd").alias(f"o{side}"))


def _confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs as edges u, v whose sets are alike: 100 * common >= per_cent * joint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                if 100 * min(len(x), len(y)) < per_cent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = np.concatenate((x, y))
                both.sort(kind="stable")  # two runs that are in order merge in linear time
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= per_cent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left, right = sets.select(F.col("node").alias("a"), F.col("set").alias("xa")), sets.select(F.col("node").alias("b"), F.col("set").alias("xb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "xa", "xb").mapInArrow(run, "u binary, v binary")


def _sets(docs: DataFrame, feats: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """node, set of the wanted nodes, from one document of each."""
    ids = feats.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("_id", "_mark")).alias("one")).select(F.col("one._id").alias("_i"), F.col("one._mark").alias("_m")).distinct()
    named = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_mark"), F.col(text_col).alias("_text"))
    texts = named.join(ids.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")), "left_semi").select("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), size) for t in batch.column(0)]
            for at in range(0, len(found), 200):
                part = [s for s in found[at : at + 200] if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in part], pa.binary()), pa.array([s.astype("<u8").tobytes() for s in part], pa.binary())], names=["node", "set"])

    return texts.mapInArrow(run, "node binary, set binary").dropDuplicates(["node"])


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, per_cent: int = 85) -> DataFrame:
    """_id, _mark (hash of the text), n_shingles, component_id for each row of docs."""
    feats = stored(features(docs, id_col, text_col, size))
    nodes = stored(feats.where("node IS NOT NULL").groupBy("node").agg(F.min("_id").alias("least"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("odd").alias("odd")))
    rows = index(nodes)
    # one pivot an entry, chosen anew by each entry's hash
    heads = rows.groupBy("entry").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("entry", "node").alias("h"), F.col("node").alias("node"))).alias("p")).where("n > 1")
    # stored, so that the join has an exchange of its own for the rows, in which a frequent entry can be split
    heads = stored(heads.select("entry", F.col("p.node").alias("pivot")))
    shared = stored(rows.join(heads, "entry"))
    pairs = shared.where("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    pairs = pairs.join(_side(nodes, "a"), "a").join(_side(nodes, "b"), "b").where(_possible(per_cent)).select("a", "b")
    pairs = stored(pairs)
    ends = shared.select("node").distinct()
    sets = stored(_sets(docs, feats, ends, id_col, text_col, size))
    edges = stored(_confirmed(pairs, sets, per_cent))
    roots = components(edges)
    # classes that share an entry but no component yet; the join itself drops the pairs that sketches rule out
    named = shared.select("entry", "node").join(roots, "node", "left").select("entry", "node", F.coalesce("root", "node").alias("root"))
    apart = named.groupBy("entry").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("entry")
    apart = stored(apart)
    rooted = stored(named.join(apart, "entry", "left_semi"))
    released(heads, shared, apart)
    met = stored(_met(sets, nodes.join(rooted.select("node").distinct(), "node", "left_semi").select("node", "sig")))
    named = stored(rooted.join(nodes.select("node", "n", "odd"), "node").join(met, "node"))
    released(rooted, met)
    x, y = (named.select("entry", F.col("node").alias(c), F.col("root").alias(f"r{c}"), F.col("n").alias(f"n{c}"), F.col("odd").alias(f"o{c}"), F.col("long").alias(f"l{c}"), F.col("entries").alias(f"e{c}"), (F.array_position("entries", F.col("entry")).cast("int") - 1).alias(f"t{c}")) for c in "ab")
    first = "NOT arrays_overlap(slice(ea, 1, ta), slice(eb, 1, tb))"  # entries of other places are never equal
    near = f"{100 + per_cent} * {_differ('la', 'lb')} <= {100 - per_cent} * (na + nb)"
    more = x.join(y, (x["entry"] == y["entry"]) & F.expr(f"a < b AND ra <> rb AND {_possible(per_cent)} AND {first} AND {near}")).select("a", "b").join(pairs, ["a", "b"], "left_anti")
    found = stored(_confirmed(more, sets, per_cent))
    if not found.isEmpty():
        roots = components(edges.unionByName(found))
    released(pairs, sets, named, edges, found)
    of = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    first = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(first, "root").select(F.col("node").alias("_node"), "component_id")
    out = feats.join(of, F.col("node") == F.col("_node"), "left")
    return out.select("_id", "_mark", "n_shingles", F.coalesce("component_id", "_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows of docs with the least id of their group; rows of empty sets all stay. Repeated rows of that id and text stay as they are."""
    ids = classes(docs, id_col, text_col, size, per_cent).where("component_id <=> _id").select(F.col("_id").alias("_keep"), "_mark").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_own"), F.xxhash64(text_col).alias("_hash"))
    return rows.join(ids.hint("shuffle_hash"), F.col("_own").eqNullSafe(F.col("_keep")) & (F.col("_hash") == F.col("_mark")), "left_semi").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classes(read(spark, sf_dir, "documents"))
    return out.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: The query by brute force: all pairs that share a shingle, counted, and what is reachable from each document.
ORACLE = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY 1),
    c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    e AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
    two AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
    r AS (SELECT doc_id AS d, doc_id AS m FROM documents UNION SELECT two.y, r.m FROM r JOIN two ON two.x = r.d),
    least AS (SELECT d, min(m) AS m FROM r GROUP BY 1)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m AS component_id, d.doc_id = m AS kept FROM documents d JOIN least ON least.d = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""
