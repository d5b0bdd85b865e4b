"""Existence checks between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, as ``key`` and number of ``rows``. NULL counts as a key like any other.

    The child is counted per key before the join, so a hot key is one row by the time it is shuffled. The join is on
    the bare key, so stored bucketing and earlier partitioning serve it.
    """
    kinds = child.schema[child_key].dataType, parent.schema[parent_key].dataType
    kind = kinds[0] if kinds[0] == kinds[1] else "string"
    counted = child.groupBy(F.col(f"`{child_key}`").cast(kind).alias("key")).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(f"`{parent_key}`").cast(kind).alias("known_key")).distinct()
    return counted.join(known, F.col("key").eqNullSafe(F.col("known_key")), "left_anti").select("key", "rows")
