"""Intermediate tables in the folder that driver and executors share: they cut lineage, and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder; a temporary one only where driver and executors are one process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = "file://" + tempfile.mkdtemp(prefix="siftline-")
    return f"{base.rstrip('/')}/siftline/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table once and read it back: what follows neither plans nor computes it again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
