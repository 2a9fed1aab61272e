"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a new local one takes its place on local masters alone, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """``df``, computed and written once: what is built on it neither computes nor plans it again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
