"""First row per key, and counts of what a de-duplication removes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """First row per key. NULL keys count as equal.

    ``order_by`` should name the ingestion sequence where there is one. Without it the order is that of all
    other columns, left to right, so that the result does not depend on how the input is partitioned. Spark cuts
    each key to one row per task before the shuffle (``WindowGroupLimit``), so a hot key does no harm.
    """
    order = [F.col(f"`{c}`").asc_nulls_last() for c in (order_by or [c for c in df.columns if c not in keys])]
    first = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(first)).where("_position = 1").drop("_position")


def copies_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of ``copies``."""
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count("*").alias("copies")).where("copies > 1")


def removed_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows that ``keep_first`` drops, as one row."""
    return copies_per_key(df, keys).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("removed"))
