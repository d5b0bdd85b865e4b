"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.columns import quoted, scattered, whole_row, word_count
from ledgerloom.llm.prefix import prefix_sums

WEIGHTS = (3, 1, 2)
BLOCK = 64


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Per source key: ``source_size``, ``target`` and ``start`` (its random offset, from 0 to below 1).

    ``sizes`` has ``source_key`` and ``size``. Sources take the weights in turn, in code point order, and divide
    ``share`` times the sum of all sizes by weight. A target stops at ``most`` times its source's size and the rest
    is divided again, until none is above: sources are filled in the order in which they reach their limit, which
    gives the end of that repetition in one pass. The table has one row per source; only this table is ordered as
    a whole.
    """
    per_source = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    ranked = per_source.withColumn("rank", F.row_number().over(Window.orderBy("source_key")))
    turn = (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")
    weighted = ranked.select(
        "source_key",
        "source_size",
        "rank",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
        (F.lit(float(most)) * F.col("source_size")).alias("limit"),
    )
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = weighted.select(
        "*",
        (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))).alias("left"),
        F.sum("weight").over(onward).alias("weight_left"),
    ).withColumn("full", F.col("limit") * F.col("weight_left") <= F.col("left") * F.col("weight"))
    open_rest = F.when(~F.col("full"), F.struct("left", "weight_left"))
    shared = filled.withColumn("open", F.first(open_rest, ignorenulls=True).over(Window.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * F.col("open.left") / F.col("open.weight_left"))
    return shared.select("source_key", "source_size", target.alias("target"), _start(F.col("source_key")).alias("start"))


def _start(source_key: Column) -> Column:
    """A random offset per source, a multiple of 2**-20 so that sums with whole numbers are exact."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), source_key)), 1, 5), 16, 10)
    return drawn.cast("long") / F.lit(float(1 << 20))


def _sampled(docs: DataFrame, carried: Sequence[Column], weights, share, most, doc_id, text, source) -> DataFrame:
    null_last = F.when(quoted(source).isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), quoted(source).cast("string")))
    rows = docs.select(
        *carried,
        quoted(doc_id).alias("own_id"),
        null_last.alias("source_key"),
        word_count(quoted(text)).alias("size"),
        scattered(quoted(doc_id), instead=quoted(text)).alias("scatter"),
    ).select("*", F.floor(F.col("size") / BLOCK).alias("block"), F.substring("scatter", 1, 2).alias("slice"))
    targets = source_targets(rows.select("source_key", "size"), weights, share, most)
    placed = prefix_sums(
        rows, ["source_key"], ["block", "size", "slice"], ["scatter", "own_id"], name="place", group_values=targets
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(F.col("start") + rate * (F.col("place") + 1)) - F.floor(F.col("start") + rate * F.col("place"))
    return placed.withColumn("copies", F.least(crossed.cast("long"), F.floor(F.lit(float(most))).cast("long")))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    Every document of a source expects target / source size copies. In the order of their sizes (ties: a scattered
    order of their ids) the expected copies are summed up, starting from one random offset per source, and a
    document is emitted once per whole number that its sum passes. Because neighbours have like sizes, the words
    taken differ from the target by less than the longest document. A null text has no words, a null source is a
    source of its own, a null id is ordered by its text. Rows equal in source, id and size are interchangeable. A
    source without words has target 0. An empty table gives no rows.

    Sums go over source, block of 64 sizes, size, and 256 slices of the ids, so that neither a hot source nor a hot
    size is sorted in one task.
    """
    sampled = _sampled(docs, [], weights, share, most, doc_id, text, source)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return sampled.select(F.col("own_id").alias("doc_id"), "size", "source_size", "target", "copies", taken)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: float = 2.0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mix_plan`` says."""
    sampled = _sampled(docs, [whole_row(docs)], weights, share, most, doc_id, text, source)
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return sampled.where("copies > 0").select("row", copies.alias("copy")).select("row.*")
