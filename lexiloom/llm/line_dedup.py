"""Line dedup by content-defined chunks of lines.

A document's lines are hashed; a rolling hash over the last REACH line hashes ends a chunk where it is divisible by
MODULUS, so boundaries depend on the lines beside them alone and an inserted line shifts no other chunk. Chunks
of at least two lines that hold a word and that stand in the corpus twice or more are removed at every place but the first,
in order of (id, place), after their bytes have been compared.

With extend, every passage is compared as well: two following lines that hold a word, with the blank lines between them.
Longer repeats are chains of passages, so a repeated run of two such lines or more goes whole, wherever the chunks
beside it end. A line goes only if an equal line stands before it, so the first of equal lines always stays; a passage
that overlaps its own first place gives up only the lines beyond it.

Edge cases: a null text stays null and has no lines; an empty text has one empty line and no repeated chunk. Chunks
without a word are kept. Rows that repeat have the same chunks: with equal ids, all of them count as the same
place only if the whole text is equal too, and then they all keep it. A chunk whose bytes differ from those of another of the
same hash is kept in place. Other columns pass through unread, whatever their names: inside, rows are packed in a struct. Rows with a
null id are of one id, and go by their text. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import read, stored

#: Lines that the rolling hash looks back on, itself included, and the mean chunk length in lines.
REACH, MODULUS = 2, 3
#: A chunk has this many lines at most, so that one text of equal lines is not one chunk.
MOST_LINES = 64
LEAST_LINES = 2
#: Bits of a place that count its lines.
LINE_BITS = 31
_PRIME = 0x100000001B3
_MASK = (1 << 64) - 1


def chunks(text: str) -> list[tuple[int, int]]:
    """(first line, lines) of each chunk of the text's \\n-split lines."""
    hashes = [xxhash.xxh3_64_intdigest(line) for line in text.encode().split(b"\n")]
    out, start = [], 0
    for i in range(len(hashes)):
        rolling = 0
        for h in hashes[max(0, i - REACH + 1) : i + 1]:
            rolling = (rolling * _PRIME + h) & _MASK
        n = i + 1 - start
        rolling ^= rolling >> 32
        if n >= LEAST_LINES and (rolling % MODULUS == 0 or n >= MOST_LINES) or i + 1 == len(hashes):
            out.append((start, n))
            start = i + 1
    return out


def chunk_texts(text: str) -> list[tuple[int, str]]:
    """(place, text) of the chunks that may be removed."""
    lines = text.split("\n")
    out = []
    for k, (start, n) in enumerate(chunks(text)):
        if n >= LEAST_LINES:
            piece = "\n".join(lines[start : start + n])
            if piece.strip():
                out.append((k, piece))
    return out


def passages(text: str) -> list[tuple[int, int]]:
    """(first line, lines) of every two following lines that hold a word, with the blank lines between them."""
    worded = [i for i, line in enumerate(text.split("\n")) if line.strip()]
    return [(i, j - i + 1) for i, j in zip(worded, worded[1:])]


def _spans(text: str, extend: bool) -> list[tuple[int, str]]:
    """(place, text) of what may be removed; a place holds the first line, above LINE_BITS, and the lines."""
    lines = text.split("\n")
    spans = [x for x in chunks(text) if x[1] >= LEAST_LINES]
    if extend:
        spans = sorted({*spans, *passages(text)})
    out = []
    for start, n in spans:
        piece = "\n".join(lines[start : start + n])
        if piece.strip():
            out.append((start << LINE_BITS | n, piece))
    return out


def _occurrences(rows: DataFrame, with_text: bool, extend: bool) -> DataFrame:
    """_id, _mark, place, chunk (128-bit hash) and, if asked for, bytes of every chunk of _text; with extend, of every passage too."""
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, texts = batch.column(0), batch.column(1), batch.column(2)
            at, place, chunk, piece, chars = [], [], [], [], 0
            wanted = [set(x) for x in batch.column(3).to_pylist()] if with_text else None
            for i, t in enumerate(texts):
                for k, p in _spans(t.as_py() or "", extend):
                    if wanted is None or k in wanted[i]:
                        at.append(i)
                        place.append(k)
                        raw = p.encode()
                        chunk.append(xxhash.xxh3_128_digest(raw))
                        if with_text:
                            piece.append(raw)
                            chars += len(raw)
                if chars > 8_000_000:
                    yield build(ids, marks, at, place, chunk, piece)
                    at, place, chunk, piece, chars = [], [], [], [], 0
            yield build(ids, marks, at, place, chunk, piece)

    def build(ids, marks, at, place, chunk, piece) -> pa.RecordBatch:
        rows_ = pa.array(at, pa.int64())
        cols = [ids.take(rows_), marks.take(rows_), pa.array(place, pa.int64()), pa.array(chunk, pa.binary())]
        return pa.RecordBatch.from_arrays(cols + [pa.array(piece, pa.binary())] * with_text, names=["_id", "_mark", "place", "chunk", "bytes"][: 4 + with_text])

    return rows.mapInArrow(run, f"_id {kind}, _mark long, place long, chunk binary" + ", bytes binary" * with_text)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extend: bool = False) -> DataFrame:
    """_id, _mark, _gone: the places of the lines to remove, for each row that has any. _mark is the hash of the row's text."""
    named = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_mark"), F.col(text_col).alias("_text"))
    found = stored(_occurrences(named, False, extend))
    first = F.min(F.struct("_id", "_mark", "place")).alias("first")
    # stored, so that the join has an exchange of its own for the rows, in which a frequent chunk can be split
    often = stored(found.groupBy("chunk").agg(F.count("*").alias("n"), first).where("n > 1").select("chunk", "first"))
    repeated = stored(found.join(often, "chunk"))
    # the bytes of every repeated chunk: equal hashes are trusted only where the least and the greatest bytes agree
    by_row = repeated.groupBy("_id", "_mark").agg(F.collect_set("place").alias("_places")).withColumnsRenamed({"_id": "_i", "_mark": "_m"})
    texts = named.join(by_row.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m"))).select("_id", "_mark", "_text", "_places")
    same = _occurrences(texts, True, extend).groupBy("chunk").agg(F.min("bytes").alias("lo"), F.max("bytes").alias("hi")).where("lo = hi").select("chunk")
    gone = repeated.join(stored(same), "chunk", "left_semi").where("NOT (first <=> struct(_id, _mark, place))")
    # of a passage that overlaps its first place, the lines beyond that
    line, n = F.shiftright("place", LINE_BITS), F.col("place").bitwiseAND(F.lit((1 << LINE_BITS) - 1))
    own = F.col("first._id").eqNullSafe(F.col("_id")) & F.col("first._mark").eqNullSafe(F.col("_mark"))
    start = F.when(own, F.greatest(line, F.shiftright(F.col("first.place"), LINE_BITS) + n)).otherwise(line)
    gone = gone.select("_id", "_mark", (F.shiftleft(start, LINE_BITS) + line + n - start).alias("place"))
    return gone.groupBy("_id", "_mark").agg(F.collect_set("place").alias("_gone"))


def _kept(text: str, gone: set[int]) -> tuple[str, int, int, int]:
    lines = text.split("\n")
    cut = {i for x in gone for i in range(x >> LINE_BITS, (x >> LINE_BITS) + (x & (1 << LINE_BITS) - 1))}
    out = [line for i, line in enumerate(lines) if i not in cut]
    return "\n".join(out), len(lines), len(lines) - len(out), len(chunks(text))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False, extend: bool = False) -> DataFrame:
    """docs with text_col less its repeated chunks and, with extend, passages. With counts: id and text alone, then n_lines, n_removed (lines) and n_chunks."""
    gone = stored(removals(docs, id_col, text_col, extend))
    own = docs.columns
    # the text stands beside the other columns, not in their struct too, so that it is moved once
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own if c != text_col]).alias("_row"), F.col(id_col).alias("_i"), F.xxhash64(text_col).alias("_m"), F.col(text_col).alias("_text"))
    joined = packed.join(gone.select(F.col("_id"), F.col("_mark"), "_gone").hint("shuffle_hash"), F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_m") == F.col("_mark")), "left")

    @F.pandas_udf("text string, n_lines long, n_removed long, n_chunks long")
    def cut(texts, gone_):
        import pandas as pd

        out = [(None, 0, 0, 0) if t is None else _kept(t, set() if g is None else set(g)) for t, g in zip(texts, gone_, strict=True)]
        return pd.DataFrame(out, columns=["text", "n_lines", "n_removed", "n_chunks"])

    if counts:
        done = joined.select("_row", cut("_text", "_gone").alias("_cut"))
        return done.select(F.col("_row")[id_col].alias(id_col), F.col("_cut")["text"].alias(text_col), "_cut.n_lines", "_cut.n_removed", "_cut.n_chunks")
    # only texts that lose lines go through Python
    changed = F.col("_gone").isNotNull()
    done = joined.select("_row", "_text", changed.alias("_changed"), cut(F.when(changed, F.col("_text")), "_gone").alias("_cut"))
    left = F.when(F.col("_changed"), F.col("_cut")["text"]).otherwise(F.col("_text"))
    return done.select(*[left.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in own])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed (lines), kept_sha256 of the text that is left (null: empty)."""
    out = dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), counts=True, extend=True)
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
