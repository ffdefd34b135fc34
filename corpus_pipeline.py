"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as parquet and read again as
the next stage's docs. All but the last return the columns of documents. n_chars stays that of the input row
where a stage leaves the text alone, and follows the text where a stage cuts it.

Edge cases, for every stage: an empty table gives an empty one with the stage's columns. A null id is an id of its own, a null
source a source of its own, and nulls in other columns pass through. A null text has no words: quality_rules drops it, and the later
stages, given one, keep it (lines, near), take nothing of it (mix), or pack it as the closing token alone (pack). Very long
texts are handled whole. Rows that repeat are equal in every stage: line_dedup keeps them alike, near_duplicates keeps
all rows of the id and text that stays, mix shares their words evenly. Ties go to the smaller id. Extra columns may have any
names; they pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import line_dedup, mixing, near_dups, packing, quality_rules
from lexiloom.llm.common import settled
from lexiloom.session import released


def _chars(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the policy of the rule ledger keeps."""
    return quality_rules.filter_rows(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, less the multi-line chunks that stand elsewhere before."""
    return _chars(line_dedup.dedup(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity of 0.8 or more."""
    return near_dups.keep_one(docs, size=5, per_cent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the source schedule takes them, in the order of its slots."""
    return _chars(mixing.apply(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack(packing.pieces(docs))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_duplicates", near), ("source_mixing", mix), ("best_fit_packing", pack)]
#: SQL has no line hashes, MinHash or token ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, settled(lambda: stage(spark, docs, sf_dir))  # noqa: B023 - called at once
        released(before)
    return STAGES[-1][1](spark, docs, sf_dir)
