"""File sinks. Every write replaces what was there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for reports of a few rows only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)
