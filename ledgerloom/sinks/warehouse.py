"""Catalog databases and tables, and the load into an external database."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerloom.functions.text import with_snake_case_columns

DATABASES = ("raw", "staging", "intermediate", "marts")


def create_databases(spark: SparkSession, names: Sequence[str] = DATABASES) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def model_table_name(layer: str | None, name: str, default_database: str = "default") -> str:
    """``database.table`` of a model: its own layer, or the default where it names none."""
    return f"{default_database if layer is None else layer.strip()}.{name}"


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its number of rows, which whatever job computes it next fills in."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def write_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
) -> int:
    """Replace a catalog table and return the number of rows written, counted by the job that writes them.

    Tables bucketed alike on a key join on it without a shuffle.
    """
    observed, rows = counted(df, f"write {table}")
    writer = observed.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if bucket_by:
        buckets, key = bucket_by
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(table)
    return rows.get["rows"]


def write_view(spark: SparkSession, name: str, select: str) -> None:
    """A persistent view: every session of the catalog reads it, and it is computed on each read."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


# The keys on which raw tables are joined to others.
JOIN_KEYS = {"orders": "product_id", "products": "product_id", "returns": "order_id"}


def load_raw(spark: SparkSession, tables: dict[str, DataFrame], database: str = "raw", buckets: int = 0) -> DataFrame:
    """Load the raw, uncleaned tables under snake_case names and return their row counts.

    The counts come from the writing jobs; nothing is read back. With ``buckets``, tables are bucketed by the key on
    which they are joined later.
    """
    create_databases(spark, [database])
    rows = []
    for name, df in tables.items():
        by = (buckets, JOIN_KEYS[name]) if buckets and name in JOIN_KEYS else None
        rows.append((write_table(with_snake_case_columns(df), f"{database}.{name}", bucket_by=by), name))
    return spark.createDataFrame(rows, "row_count long, table_name string")


@contextmanager
def scratch_databases(spark: SparkSession, folder: str, *names: str) -> Iterator[list[str]]:
    """Databases of their own under ``folder``, dropped with all they hold at the end."""
    mark = uuid.uuid4().hex[:12]
    made = [f"{name}_{mark}" for name in names]
    try:
        for name in made:
            spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/{name}'")
        yield made
    finally:
        for name in made:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 5000, connections: int = 8, **options: str) -> None:
    """Replace a table of an external database with batched inserts over a bounded number of connections.

    The rows are shuffled to the connections; ``coalesce`` would run everything before the load on as few tasks.
    """
    (
        df.repartition(connections)
        .write.mode("overwrite")
        .format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch_rows), **options)
        .save()
    )
