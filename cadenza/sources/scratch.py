"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that is set, else that of spark.checkpoint.dir; a temporary one only where all is one process."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and context.master.startswith("local"):
            named = tempfile.mkdtemp(prefix="cadenza-")
        if not named:
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
