"""Text shards of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import n_bytes
from lexiloom.operators.streams import pieces, running_total
from lexiloom.sources.documents import END_OF_DOCUMENT

MB = 1 << 20
SHARD_BYTES = 256 * MB


def chunk_of_start(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows and bytes of each chunk where a text belongs to the chunk that its first byte falls in. A chunk may overrun the limit by its last text."""
    placed = running_total(docs.select(id_col, n_bytes(F.col(text_col)).alias("bytes")), id_col, "bytes", ties=("bytes",))
    return placed.groupBy(F.floor(F.col("start") / limit).alias("chunk")).agg(F.count("*").alias("n_docs"), F.sum("bytes").cast("long").alias("bytes"))


def cut_text(text: str, limit: int) -> list[str]:
    """The text in parts of at most `limit` UTF-8 bytes: after the last line end that fits, or else between two characters."""
    raw = text.encode()
    out, at = [], 0
    while len(raw) - at > limit:
        end = raw.rfind(b"\n", at, at + limit) + 1
        if end <= at:
            end = at + limit
            while end > at and raw[end] & 0xC0 == 0x80:  # inside a character
                end -= 1
            if end == at:
                raise ValueError(f"a character is longer than {limit} bytes")
        out.append(raw[at:end].decode())
        at = end
    out.append(raw[at:].decode())
    return out


def split_texts(docs: DataFrame, limit: int = SHARD_BYTES, text_col: str = "text") -> DataFrame:
    """docs with each text that is longer than `limit` bytes cut in parts, a row for each, numbered in `part` from 0. Nulls stay."""
    names = docs.columns
    k = names.index(text_col)
    short = docs.where(F.col(text_col).isNull() | (F.octet_length(text_col) <= limit)).withColumn("part", F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [cut_text(t.as_py(), limit) for t in batch.column(k)]
            rows = pa.array([i for i, c in enumerate(cuts) for _ in c], pa.int64())
            cols = [batch.column(j).take(rows) if j != k else pa.array([t for c in cuts for t in c], pa.string()) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([n for c in cuts for n in range(len(c))], pa.int32())], names=[*names, "part"])

    long = docs.where(F.octet_length(text_col) > limit).mapInArrow(run, short.schema)
    return short.unionByName(long)


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text", overhead: int = 1) -> DataFrame:
    """split_texts(), with the 1-based shard of each part. No shard has more than `limit` bytes, `overhead` for each row included.

    Parts are laid end to end in order of id, in slots of half the limit; slot k holds what starts in it and so less than the
    limit where no part is longer than half of it. So texts are cut at half the limit, and shards are half full at least,
    but for the last."""
    half = limit // 2
    rows = split_texts(docs, half - overhead, text_col).withColumn("_bytes", n_bytes(F.col(text_col)) + overhead)
    placed = running_total(rows, id_col, "_bytes", "_start", ties=("part", "_bytes"))
    return placed.withColumn("shard", (F.floor(F.col("_start") / half) + 1).cast("int")).drop("_bytes")


def write_text_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes `path`/shard=N/*.txt, one file a shard, a record a text: the text and END_OF_DOCUMENT, so that texts of several lines
    stay apart. Rows without text are left out; END_OF_DOCUMENT inside a text becomes a line end."""
    rows = docs.where(F.col(text_col).isNotNull()).withColumn(text_col, F.replace(F.col(text_col), F.lit(END_OF_DOCUMENT), F.lit("\n")))
    rows = assign_shards(rows, limit, id_col, text_col, overhead=len(END_OF_DOCUMENT))
    rows = rows.repartition("shard").sortWithinPartitions("shard", "_start")
    rows.select("shard", F.col(text_col).alias("value")).write.partitionBy("shard").mode("overwrite").option("lineSep", END_OF_DOCUMENT).text(path)


def stream_shards(docs: DataFrame, limit: int, id_col: str = "doc_id", length=lambda text: n_bytes(text), text_col: str = "text") -> DataFrame:
    """id, shard (1-based), start in the stream and length of each piece where the whole stream is cut every `limit` units."""
    placed = running_total(docs.select(id_col, length(F.col(text_col)).alias("_length")), id_col, "_length", "_start", ties=("_length",))
    found = placed.select(id_col, F.explode(pieces(F.col("_start"), F.col("_length"), limit)).alias("p"))
    return found.select(id_col, (F.col("p.part") + 1).cast("int").alias("shard"), F.col("p.start").alias("start"), F.col("p.length").alias("length"))
