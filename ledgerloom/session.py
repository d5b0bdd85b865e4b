"""Session settings the plans are written for. A cluster may set its own; nothing depends on them."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str | None = None, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
