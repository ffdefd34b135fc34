"""The corpus preparation from end to end: raw files to text shards, to a vocabulary, to token shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiloom.operators import bpe
from lexiloom.operators.shards import MB, SHARD_BYTES, write_text_shards
from lexiloom.session import ship, stored
from lexiloom.sources.documents import doc_ids, read_crawl, read_documents, read_epub, read_pdf, read_text
from lexiloom.sources.tokens import stream_of, write_tokens

#: Fixed value: the name that a vocabulary is saved under.
TOKENIZER = "kendi_tokenizerim.json"


def _numbered(docs: DataFrame) -> DataFrame:
    """doc_id and text; ids follow the paths and texts, so reruns agree."""
    return docs.select(doc_ids(docs, "path", "text").alias("doc_id"), "text")


def to_text(spark: SparkSession, kind: str, source: str, target: str, lang: str | None = None, limit_mb: int = SHARD_BYTES // MB, errors: str = "raise") -> None:
    """Files of a kind (pdf, epub, crawl, txt) under `source` to text shards of at most limit_mb under `target`."""
    ship(spark)
    if kind == "crawl" and not lang:
        raise ValueError("crawl records need a language")
    readers = {"pdf": lambda: read_pdf(spark, source, errors), "epub": lambda: read_epub(spark, source, errors), "crawl": lambda: read_crawl(spark, source, lang), "txt": lambda: read_text(spark, source)}
    if kind not in readers:
        raise ValueError(f"a kind is one of {', '.join(readers)}, not {kind}")
    write_text_shards(stored(_numbered(readers[kind]())), target, limit_mb * MB)


def build_tokenizer(spark: SparkSession, source: str, target: str, vocab_size: int = bpe.VOCAB_SIZE, min_frequency: int = 1, turkish: bool = False) -> bpe.Vocabulary:
    """Learns a vocabulary from the documents of all text files under `source` and saves it under `target`."""
    ship(spark)
    vocabulary = bpe.learn(read_documents(spark, source), vocab_size, min_frequency, turkish=turkish)
    vocabulary.save(spark, f"{target.rstrip('/')}/{TOKENIZER}")
    return vocabulary


def tokenize(spark: SparkSession, source: str, target: str, tokenizer: str | None = None, dtype: str = "u16", limit_mb: int = SHARD_BYTES // MB, separator: int | None = None, turkish: bool = False) -> None:
    """The ids of all documents in the text files under `source`, as numbered token shards under `target`, `separator` after each
    document if given. Documents follow one another by a hash of their path and text."""
    ship(spark)
    vocabulary = bpe.Vocabulary.load(spark, tokenizer or f"{source.rstrip('/')}/{TOKENIZER}")
    if dtype == "u16" and len(vocabulary.tokens) > 1 << 16:
        raise ValueError(f"{len(vocabulary.tokens)} tokens do not fit u16; u32 holds them")
    docs = _numbered(read_documents(spark, source))
    rows = stored(bpe.encode(docs, vocabulary, separator=separator, turkish=turkish).select("doc_id", "tokens"))
    write_tokens(stream_of(rows, "doc_id"), target, dtype, limit_mb * MB)
