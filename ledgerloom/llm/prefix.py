"""Prefix sums within groups of any size, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def prefix_sums(
    rows: DataFrame,
    group: Sequence[str],
    digits: Sequence[str],
    order: Sequence[str],
    value: str | None = None,
    name: str = "before",
    group_values: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` (or the number of rows) before each row, within its group.

    Rows are ordered by ``digits`` and then by ``order``. Each digit splits a group into sub-groups; sums go up
    this tree by aggregation and offsets come down by joins, so a task only ever sorts one innermost sub-group or
    the sub-totals of one digit. Choose digits with few values each. ``group`` and ``digits`` must not be null.
    ``group_values`` has one row per group; its other columns are added.
    """
    keys = [*group, *digits]
    amount = F.lit(1).cast("long") if value is None else F.col(value)
    totals = rows.groupBy(*keys).agg(F.sum(amount).alias("_sum"))
    offsets = group_values
    for depth, digit in enumerate(digits):
        upper = [*group, *digits[:depth]]
        level = totals.groupBy(*upper, digit).agg(F.sum("_sum").alias("_sum"))
        earlier = Window.partitionBy(*upper).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        level = level.select(*upper, digit, _or_zero(F.sum("_sum").over(earlier)).alias("_here"))
        if offsets is None:
            offsets = level.withColumnRenamed("_here", "_offset")
            continue
        offsets = level.join(offsets, upper)
        known = F.col("_offset") if "_offset" in offsets.columns else F.lit(0)
        offsets = offsets.withColumn("_offset", known + F.col("_here")).drop("_here")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_inside", _or_zero(F.sum(amount).over(inside)))
    return summed.join(offsets, keys).withColumn(name, F.col("_offset") + F.col("_inside")).drop("_offset", "_inside")


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))
