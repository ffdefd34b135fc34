"""Raw documents as rows: plain text, web-crawl records, EPUB and PDF files."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from urllib.parse import unquote
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions.text import markup_text
from lexiloom.sources.pdf import pdf_text

#: What follows each document in a text shard: a record separator and a line end.
END_OF_DOCUMENT = "\x1e\n"
#: Fields of a crawl record.
CRAWL = "text string, timestamp string, url string"


def read_text(spark: SparkSession, path: str, whole: bool = True, suffix: str = ".txt") -> DataFrame:
    """path and text of the plain-text files under a folder, at any depth; a row for each file, or for each line."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    return reader.text(path, wholetext=whole).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_documents(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """path and text of the documents in the text shards under a folder: what END_OF_DOCUMENT parts. Shards are read in splits, and a
    row is a document, however large its shard. A file without END_OF_DOCUMENT, as others write them, is one document."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").option("lineSep", END_OF_DOCUMENT)
    return reader.text(path).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def of_language(docs: DataFrame, lang: str, column: str = "lang") -> DataFrame:
    """Rows of one language by its column: a filter that reaches the scan."""
    return docs.where(F.col(column) == lang)


def read_crawl(spark: SparkSession, path: str, lang: str | None = None) -> DataFrame:
    """path, url, timestamp and text of crawl records in (compressed) JSON lines. With `lang`, files whose name has it between
    a hyphen and a stop or hyphen, as in c4-tr.00000.json.gz; other files are not opened."""
    reader = spark.read.schema(CRAWL).option("recursiveFileLookup", True)
    if lang:
        reader = reader.option("pathGlobFilter", f"*-{lang}[.-]*")
    return reader.json(path).select(F.input_file_name().alias("path"), "url", "timestamp", "text")


def epub_text(content: bytes) -> str:
    """The chapters of a book in reading order, a blank line between them."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        container = ElementTree.fromstring(book.read("META-INF/container.xml"))
        package = next(e.attrib["full-path"] for e in container.iter() if e.tag.endswith("rootfile"))
        root, base = ElementTree.fromstring(book.read(package)), posixpath.dirname(package)
        items = {e.attrib["id"]: e.attrib for e in root.iter() if e.tag.endswith("}item")}
        order = [e.attrib["idref"] for e in root.iter() if e.tag.endswith("}itemref") and e.attrib.get("linear") != "no"]
        out = []
        for name in order:
            item = items.get(name, {})
            if "html" in item.get("media-type", ""):
                chapter = book.read(posixpath.normpath(posixpath.join(base, unquote(item["href"]))))
                if text := markup_text(chapter.decode("utf-8-sig")):
                    out.append(text)
    return "\n\n".join(out)


def texts_of(files: DataFrame, read, content_col: str = "content", errors: str = "raise") -> DataFrame:
    """files with text in place of their bytes. `errors`: "raise", or "null" to keep a file that cannot be read as a null text."""
    kept = [c for c in files.columns if c != content_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for raw in batch.column(len(kept)):
                try:
                    texts.append(read(raw.as_py()) if raw.is_valid else None)
                except Exception:
                    if errors == "raise":
                        raise
                    texts.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string())], names=[*kept, "text"])

    rows = files.select(*[F.col(f"`{c}`") for c in kept], F.col(content_col))
    return rows.mapInArrow(run, rows.drop(content_col).schema.add("text", "string"))


def _files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path).select("path", "content")


def read_epub(spark: SparkSession, path: str, errors: str = "raise") -> DataFrame:
    """path and text of the EPUB files under a folder."""
    return texts_of(_files(spark, path, ".epub"), epub_text, errors=errors)


def read_pdf(spark: SparkSession, path: str, errors: str = "raise", backend: str = "auto") -> DataFrame:
    """path and text of the PDF files under a folder; `backend` as in pdf_text()."""
    return texts_of(_files(spark, path, ".pdf"), lambda raw: pdf_text(raw, backend), errors=errors)


def doc_ids(docs: DataFrame, *by: str) -> Column:
    """An id for rows that have none: a hash of the named columns, the same on every run."""
    return F.xxhash64(*[F.col(c) for c in by or docs.columns])
