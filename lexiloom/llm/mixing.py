"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

The mix has 2^k slots of equal token blocks. Slot j stands at the van der Corput point of j (its k bits
reversed, over 2^k), and the cumulative target weights map that point to a source: slots of a source come
evenly spaced, in any prefix of the schedule. A source gives its exact target, to the word, dealt evenly over the
slots that it holds; a source whose target is under a slot shares the slot that its interval lies in. The r-th slot of
a source, in the order of the mix, takes the r-th block of that source's documents, shuffled by a seeded hash and laid
end to end, beginning anew after the last one. So every prefix of the mix takes a prefix of each source's stream, and
what a document gives, and where, follows from its place in the stream, which is summed without holding a source in
one task. A document stands whole in the slot that its first word falls in.

Edge cases: null text has size 0 and gives nothing; a null source is a source of its own, ordered last. Rows
with the same id and text are separate rows, put in order by their content, so reruns agree. A table whose
sizes are all 0, or an empty one, gives targets of 0. Columns of the input may have any names: inside,
only prefixed ones are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiloom.llm.common import n_words, ranked, read, stored

#: Weights by the rank of a source, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source is repeated so many times at most.
MAX_EPOCHS = 3
#: Words that a slot's block has at least, and log2 of the most slots there are: beyond their product blocks grow with the mix.
SLOT_WORDS, SLOT_BITS = 256, 20
SEED = 20240229


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """_id, _source, _size, _order of each row: the narrow table that the plan is made of."""
    one = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col(text_col).alias("_text"))
    return one.select("_id", "_source", n_words(F.col("_text")).alias("_size"), F.xxhash64(F.lit(seed), "_id", "_text").alias("_order"))


def targets(narrow: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, slot_bits: int = SLOT_BITS) -> DataFrame:
    """A row for each source: _source, _source_size, _target (exact share), _first and _slots (its interval), _n (all slots) and
    _quota (words the schedule takes).

    The windows without a partition run over one row a source, not over documents. The shares fill up like
    water: in order of cap / weight the first sources stop at their cap, and the level of the rest is what
    remains over their weights."""
    by = narrow.groupBy("_source").agg(F.sum("_size").cast("long").alias("_source_size"))
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by = by.withColumn("_w", F.get(cycle, (F.row_number().over(order) - 1) % len(weights)))
    by = by.withColumn("_cap", (max_epochs * F.col("_source_size")).cast("double"))
    all_ = Window.partitionBy()
    rise = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_source").asc_nulls_last())
    through = rise.rowsBetween(Window.unboundedPreceding, 0)
    by = by.withColumn("_total", F.sum("_source_size").over(all_))
    # the level if the sources up to and without this one are capped
    by = by.withColumn("_left_w", F.sum("_w").over(all_) - F.sum("_w").over(through) + F.col("_w"))
    by = by.withColumn("_left", F.col("_total") - F.sum("_cap").over(through) + F.col("_cap"))
    by = by.withColumn("_level", F.when(F.col("_left") / F.col("_left_w") <= F.col("_cap") / F.col("_w"), F.col("_left") / F.col("_left_w")))
    by = by.withColumn("_level", F.max("_level").over(all_))
    by = by.withColumn("_target", F.when(F.col("_total") == 0, F.lit(0.0)).otherwise(F.coalesce(F.least(F.col("_cap"), F.col("_level") * F.col("_w")), F.col("_cap"))))
    # van der Corput points of j < 2^k are the multiples of 2^-k, so the slots of an interval are counted without listing them
    bits = F.when(F.col("_total") > 0, F.least(F.lit(slot_bits), F.floor(F.log2(F.greatest(F.col("_total") / SLOT_WORDS, F.lit(1))))).cast("int")).otherwise(F.lit(0))
    by = by.withColumn("_n", F.pow(F.lit(2.0), bits).cast("long"))
    line = order.rowsBetween(Window.unboundedPreceding, 0)
    to = F.sum("_target").over(line)
    edge = lambda x: F.when(F.col("_total") == 0, F.lit(0)).otherwise(F.least(F.col("_n"), F.ceil(x / F.col("_total") * F.col("_n")))).cast("long")
    by = by.withColumn("_to", edge(to)).withColumn("_first", F.lag("_to", 1, 0).over(order)).withColumn("_slots", F.col("_to") - F.col("_first"))
    # of the exact target, not of whole slots: a source under a slot still gives its share, and the last slot of a source is partial
    quota = F.least(F.round("_target").cast("long"), F.lit(max_epochs) * F.col("_source_size"))
    return by.withColumn("_quota", F.coalesce(quota, F.lit(0))).select("_source", "_source_size", "_target", "_first", "_slots", "_n", "_quota")


def _rank(at: Column) -> Column:
    """The block of its source's stream that word `at` of the stream falls in: the quota is dealt evenly over the slots held."""
    wide = "decimal(38,0)"  # products of words and slots exceed a long
    return F.call_function("div", at.cast("decimal(19,0)") * F.greatest(F.col("_slots"), F.lit(1)).cast("decimal(19,0)"), F.greatest(F.col("_quota"), F.lit(1)).cast(wide)).cast("long")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """_id, _source, _size, _order, _source_size, _target, _taken and _times for each row of docs.

    _times has a struct for each time that the row is taken: _slot (place in the mix), _rank (block of the source) and
    _words (taken then: all, or the first ones where the source's target ends)."""
    narrow = stored(sizes(docs, id_col, text_col, source_col, seed))
    by = stored(targets(narrow, weights, max_epochs))
    placed = ranked(narrow, "_source", ["_order", "_id"], "_size", "_start")
    out = placed.join(by.withColumnRenamed("_source", "_of"), F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
    # the stream is the source again and again: the places where this row stands in it, as far as the quota goes
    begin = lambda e: e * F.col("_source_size") + F.col("_start")
    words = lambda e: F.greatest(F.lit(0), F.least(F.col("_size"), F.col("_quota") - begin(e))).cast("long")
    epochs = F.sequence(F.lit(0).cast("long"), F.lit(max_epochs - 1).cast("long"))
    times = F.filter(F.transform(epochs, lambda e: F.struct(_rank(begin(e)).alias("_rank"), words(e).alias("_words"))), lambda t: t["_words"] > 0)
    out = stored(out.select("_id", "_source", "_size", "_order", "_source_size", "_target", "_n", F.monotonically_increasing_id().alias("_row"), times.alias("_t")))
    each = out.select("_row", F.col("_source").alias("_of"), F.explode("_t").alias("_t")).select("_row", "_of", "_t.*")
    slots = held(by).select(F.col("_source").alias("_s"), F.col("rank").alias("_r"), F.col("slot").alias("_slot"))
    each = each.join(slots, F.col("_of").eqNullSafe(F.col("_s")) & (F.col("_rank") == F.col("_r")))
    each = each.groupBy("_row").agg(F.sum("_words").alias("_taken"), F.sort_array(F.collect_list(F.struct("_rank", "_slot", "_words"))).alias("_times"))
    out = out.drop("_t").join(each, "_row", "left")
    none = F.array().cast("array<struct<_rank:bigint,_slot:bigint,_words:bigint>>")
    return out.select("_id", "_source", "_size", "_order", "_source_size", "_target", "_n", F.coalesce("_taken", F.lit(0)).cast("long").alias("_taken"), F.coalesce("_times", none).alias("_times"))


def _reversed(v: Column, width: Column) -> Column:
    """The lowest `width` bits of v in reverse."""
    x = v
    for shift, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        x = F.shiftright(x, shift).bitwiseAND(F.lit(mask)).bitwiseOR(F.shiftleft(x.bitwiseAND(F.lit(mask)), shift))
    x = F.shiftright(x, 32).bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.shiftleft(x, 32))
    return F.when(width == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", x, F.lit(64) - width))


def schedule(by: DataFrame) -> DataFrame:
    """The slots of targets(): slot (its place in the mix), _source, and rank among the source's slots, which is the block it takes.

    Slots of a source are consecutive multiples of 2^-k; the bits of each, reversed, are its place."""
    slots = by.where("_slots > 0").select("_source", "_n", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_slots") - 1)).alias("_v"))
    width = F.log2(F.col("_n")).cast("int")
    place = _reversed(F.col("_v"), width)
    slots = stored(slots.select("_source", place.alias("slot"), F.call_function("shiftleft", place, F.lit(63) - width).alias("_order")))
    return ranked(slots, "_source", ["_order"], None, "rank").select("slot", "_source", "rank")


def held(by: DataFrame) -> DataFrame:
    """schedule(), with rank 0 of a source that has words but no slot of its own: the slot that its interval lies in."""
    width = F.log2(F.col("_n")).cast("int")
    small = by.where("_slots = 0 AND _quota > 0").select(_reversed(F.col("_first") - 1, width).alias("slot"), "_source", F.lit(0).cast("long").alias("rank"))
    return schedule(by).unionByName(small)


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, slot_col: str | None = None) -> DataFrame:
    """docs as mixed, in the order of the schedule's slots: a row for each time a document is taken, the last one cut to the
    words that are taken of it.

    Rows that the mix takes nothing of are left out. The columns are those of docs and, if slot_col names it, the slot.
    Partitions hold ranges of slots one after another, and rows in them stand in order; as slots have equal blocks, so have the partitions."""
    p = plan(docs, id_col, text_col, source_col, weights, max_epochs, seed).where("_taken > 0")
    # the same hash of id and text as in sizes() finds the row again; rows equal in these share their words evenly, rounded down
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_order"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source"))
    shared = ["_id", "_order", "_source"]
    first = F.array(*[F.min(F.get("_times", F.lit(e))["_slot"]) for e in range(max_epochs)])
    p = p.groupBy(*shared).agg(F.floor(F.sum("_taken") / F.count("*")).alias("_taken"), F.max("_size").alias("_size"), first.alias("_slots"), F.max("_n").alias("_n")).where("_taken > 0")
    hit = keyed.join(p.select(*[F.col(c).alias(f"_p{c}") for c in shared], "_taken", "_size", "_slots", "_n"), [keyed[c].eqNullSafe(F.col(f"_p{c}")) for c in shared])
    whole, rest = F.floor(F.col("_taken") / F.col("_size")), F.col("_taken") % F.col("_size")
    turns = F.transform(F.sequence(F.lit(1), whole + F.when(rest > 0, 1).otherwise(0)), lambda i: F.struct(F.when(i > whole, rest).alias("cut"), F.coalesce(F.get("_slots", i.cast("int") - 1), F.lit(0)).alias("slot")))
    times = hit.select("_row", "_order", "_n", F.explode(turns).alias("_t")).select("_row", "_order", "_n", F.col("_t.cut").alias("_cut"), F.col("_t.slot").alias("_slot"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    times = times.repartitionById(n, F.call_function("div", F.col("_slot") * n, F.col("_n")).cast("int")).sortWithinPartitions("_slot", "_order", "_cut")
    text = F.col("_row")[text_col]
    # the first _cut words with the white space between them
    cut = F.regexp_substr(text, F.concat(F.lit(r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){"), F.col("_cut").cast("string"), F.lit("}+")))
    out = [F.when(F.col("_cut").isNull(), text).otherwise(F.regexp_replace(cut, r"[\x20\x09-\x0D]+$", "")).alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    return times.select(*out, *([F.col("_slot").alias(slot_col)] if slot_col else []))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the columns asked for: slot, the place in the mix where the document stands first (null: nowhere), and n_times."""
    p = plan(read(spark, sf_dir, "documents"))
    return p.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"), F.get("_times", F.lit(0))["_slot"].alias("slot"), F.size("_times").alias("n_times"))
