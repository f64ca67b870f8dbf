"""Shared working folders, and what every operator of this package sets.

Executors share only the folder that the cluster names in
``spark.checkpoint.dir``; tables and files that cut lineage go there.  Only
where the setting is empty and driver and executors are one process (local
tests) a temporary folder is used instead; a cluster must name one.
"""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch: documents can be long.
BATCH_ROWS = 512


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        known = spark.sparkContext.getCheckpointDir()
        if known:
            return known
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="siftline-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def tune(spark: SparkSession) -> None:
    """Keep Arrow batches of whole documents small."""
    shared_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run of an operator."""
    return f"{shared_dir(spark).rstrip('/')}/siftline/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table once and read it back: later stages do not recompute it."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared path, on an executor."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
