"""Materialise an intermediate result that several later jobs read."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder named by ``spark.checkpoint.dir``.

    Survives the loss of executors, unlike a local checkpoint. A temporary folder is used only by a local
    session that names none.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="ledgerloom-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
