"""Connected components of a graph whose edges are a DataFrame, by alternating stars.

Edge cases: edges with a null end and edges of a node to itself are dropped, repeated ones count once, no edges give no rows. Nodes are
of any type that Spark orders; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import stored
from lexiloom.session import released


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours, moved to its least one: those above the node (large star) or those up to it (small star).

    The least ones are stored, so that the join has an exchange of its own for the edges, in which those of a node with many
    neighbours can be split, or none where they are few enough to be broadcast. Edges have to be a stored table."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    # edges run from the larger to the smaller node, so in the small star only those stand with their larger end
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")))
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
    out = stored(moved)
    released(least)
    return out


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """node, root for each node of an edge (u, v) that is not the least of its component, which is the root. Self-edges are dropped.

    Rounds of large star and small star, which halve distances, until the edges are stars. Each star is
    stored, so the plan stays short; the number of rounds grows with the logarithm of the longest path."""
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        above = _star(now, True)
        released(now)
        now = _star(above, False)
        released(above)
        # stars: every node has one edge, to a node that has none of its own; sums of hashes tell a change
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
