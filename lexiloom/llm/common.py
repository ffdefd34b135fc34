"""What the training-data operators share: stored intermediates, words, and distributed ranks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom import session
from lexiloom.session import ship

#: The white space that separates words, as a Java and RE2 character class and as characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """session.stored(), with this package given to the executors that run df."""
    ship(df.sparkSession)
    return session.stored(df)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """session.settled(), with this package given to the executors."""
    ship(SparkSession.active())
    return session.settled(make)


def key_of(df: DataFrame, name: str) -> Column:
    """The id column without nulls, for joins: a null becomes the least long, or a string that no id has."""
    kind = df.schema[name].dataType.simpleString()
    null = F.lit("\0") if kind == "string" else F.lit(-(2**63) if kind == "bigint" else -(2**31)).cast(kind)
    return F.coalesce(F.col(name), null)


def id_of(df: DataFrame, key: Column, name: str) -> Column:
    """The id again from key_of()."""
    kind = df.schema[name].dataType.simpleString()
    null = F.lit("\0") if kind == "string" else F.lit(-(2**63) if kind == "bigint" else -(2**31)).cast(kind)
    return F.nullif(key, null)


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, also where body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The maximal runs of characters outside SPACE_CLASS."""
    return F.array_remove(F.split(text, SPACE_CLASS + "+"), "")


def n_words(text: Column) -> Column:
    """size(words(text)) by counting white-space runs; no array is built. Null text has 0."""
    trimmed = F.btrim(text, F.lit(SPACES))
    inner = F.size(F.split(trimmed, SPACE_CLASS + "+"))
    return F.when(text.isNull() | (trimmed == ""), F.lit(0)).otherwise(inner).cast("long")


#: Slices that ranked() cuts the hash range in at most.
MOST_SLICES = 1 << 16


def ranked(df: DataFrame, key: str, order: list[str], size: str | None, out: str, per_slice: int = 250) -> DataFrame:
    """df with out: the sum of size (1 each where None) over the rows before it, among rows of the same key,
    in the order given. order[0] must be an evenly spread integer (a hash); the others break ties.

    No task holds a whole key: rows go by (key, slice of the hash range), slices are summed, and only the
    table of slice sums is summed along a key. There are rows / per_slice slices, but MOST_SLICES at most, so that a key's
    sums stay few. Two passes over df, which should be a stored table."""
    weight = F.col(size) if size else F.lit(1)
    total = df.count()
    bits = min(MOST_SLICES.bit_length() - 1, (max(1, total) // per_slice).bit_length())
    part = F.lit(0) if bits == 0 else F.shiftrightunsigned(F.col(order[0]), 64 - bits).cast("int")
    df = df.withColumn("_slice", part)
    # hashes are signed: read unsigned, the slices follow one another
    sums = df.groupBy(key, "_slice").agg(F.sum(weight).cast("long").alias("_sum"))
    along = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(key).alias("_key"), F.col("_slice").alias("_s"), F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    joined = df.join(sums, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_s")))
    return joined.withColumn(out, (F.col("_before") + F.col("_inside")).cast("long")).drop("_slice", "_key", "_s", "_before", "_inside")
