"""Folders that the driver and all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may go without and gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerloom-shared-")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: it survives lost executors and is computed once."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are gone.

    It does when the driver's JVM happens to collect its garbage. After a checkpoint nothing reads them, and those of
    one step would lie beside those of the next. Spark may hold the frame that it ran last, so call it a job later.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
