"""Counts of words, characters and adjacent pairs: what a vocabulary is learned from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import words


def word_counts(docs: DataFrame, text_col: str = "text", min_frequency: int = 1) -> DataFrame:
    """word and n of each word that stands min_frequency times or more. Counts are summed before the shuffle."""
    counted = docs.select(F.explode(words(F.col(text_col))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_frequency) if min_frequency > 1 else counted


def alphabet_counts(counts: DataFrame) -> DataFrame:
    """symbol and n of each character of counted words."""
    one = counts.select("n", F.explode(F.split("word", "")).alias("symbol")).where("symbol <> ''")
    return one.groupBy("symbol").agg(F.sum("n").alias("n"))


def pair_counts(counts: DataFrame) -> DataFrame:
    """left, right and n of each pair of characters that are neighbours in counted words."""
    chars = counts.select("n", F.filter(F.split("word", ""), lambda c: c != "").alias("c")).where("size(c) > 1")
    pairs = chars.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.size("c") - 1), lambda i: F.struct(F.get("c", i - 1).alias("left"), F.get("c", i).alias("right")))).alias("p"))
    return pairs.groupBy("p.left", "p.right").agg(F.sum("n").alias("n"))
