"""Whole files, packet documents and baselines as DataFrames."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKET = "schema_version string, packet_id string, artifact_id string, harness string, source_version string, event_ids array<string>, events array<struct<event_id:string,ordinal:bigint,timestamp:string,role:string,evidence_strength:string,evidence_uri:string,text:string>>"


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, bytes and SHA-256 of whole files; each file must fit a task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def combined_hash(hashes: DataFrame) -> DataFrame:
    """One hash of a path-to-hash map, whatever the order (a list of files, not of records)."""
    pairs = F.array_sort(F.collect_list(F.struct("path", "sha256")))
    return hashes.agg(F.sha2(F.to_json(F.map_from_entries(pairs)), 256).alias("sha256"))


def packet_documents(spark: SparkSession, path: str, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that the manifest lists and that agree with it, ids of those that don't)."""
    docs = spark.read.schema(PACKET).json(path, multiLine=True)
    joined = manifest.select("packet_id", F.col("event_ids").alias("m_ids"), F.col("artifact_id").alias("m_artifact")).join(docs, "packet_id", "left")
    own = F.col("events.event_id")
    fine = F.coalesce((F.col("event_ids") == F.col("m_ids")) & (F.col("artifact_id") == F.col("m_artifact")) & (F.array_sort(own) == F.array_sort("event_ids")), F.lit(False))
    return joined.filter(fine).drop("m_ids", "m_artifact"), joined.filter(~fine).select("packet_id")


def one_file(spark: SparkSession, path: str, name: str) -> str:
    """The path of the only file of a name below path; none or several are an error."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(path).select("path").limit(2).collect()
    if len(found) != 1:
        raise LookupError(f"{len(found)} files of that name")
    return found[0].path


def baseline(spark: SparkSession, path: str) -> DataFrame:
    """(id, text) of a JSON object of texts, sorted and stripped: small, and frozen before any candidate."""
    with open(path, encoding="utf-8") as f:
        items = json.load(f)
    return spark.createDataFrame(sorted((str(k), str(v).strip()) for k, v in items.items()), "id string, text string")


@F.pandas_udf(T.ArrayType(T.StringType()))
def text_leaves(values: pd.Series) -> pd.Series:
    """All strings of a JSON value in depth-first order; recursion has no expression."""

    def leaves(v) -> list[str]:
        if isinstance(v, str):
            return [v]
        if isinstance(v, dict):
            return [x for y in v.values() for x in leaves(y)]
        if isinstance(v, list):
            return [x for y in v for x in leaves(y)]
        return []

    def read(raw: str | None) -> list[str]:
        try:
            return leaves(json.loads(raw or ""))
        except ValueError:
            return []

    return values.map(read)
