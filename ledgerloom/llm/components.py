"""Connected components of a graph of any size, by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.storage import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges``, which has longs ``u`` and ``v``.

    Each round is two aggregations and two joins, written to the shared folder; it ends when the edges no longer
    change. A hot node is aggregated before the shuffle, and Spark splits the joins on it. Edges from a node to
    itself only name the node.
    """
    edges = checkpointed(edges)
    named = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    current = checkpointed(_downward(edges))
    state = _state(current)
    while True:
        following = checkpointed(_small_star(_large_star(current)))
        now = _state(following)
        current = following
        if now == state:
            break
        state = now
    labels = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    joined = named.join(labels, "node", "left")
    return joined.select("node", F.coalesce("component", "node").alias("component"))


def _downward(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    mix = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mix), F.sum(mix.cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and all its neighbours below it are linked to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    below = edges.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return below.unionByName(least.select("u", F.col("least").alias("v"))).distinct()
