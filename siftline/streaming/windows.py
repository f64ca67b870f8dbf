"""Structured Streaming variants: windowed counts with late data, and a resumable ledger."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "attempts int, last string, done boolean"
LEDGER = "item string, attempt int, outcome string, terminal boolean"


def windowed_counts(events: DataFrame, time: str, key: str, width: str, delay: str, slide: str | None = None) -> DataFrame:
    """Counts by window and key; rows later than delay behind the watermark are dropped (and counted, see late_rows)."""
    return events.withWatermark(time, delay).groupBy(F.window(time, width, slide), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str, delay: str) -> DataFrame:
    """Session windows that close after a gap."""
    return events.withWatermark(time, delay).groupBy(F.session_window(time, gap), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def deduplicated(events: DataFrame, time: str, key: str, delay: str) -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def attempt_ledger(events: DataFrame, item: str, order: str, outcome: str, failure: str) -> DataFrame:
    """Numbered attempts of each item; the same failure twice in a row, or any other outcome, ends it."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attempts, last, done = state.get if state.exists else (0, "", False)
        rows = []
        # a trigger's rows of a key come in several frames: ordered together
        for value in pd.concat(list(frames)).sort_values(order)[outcome]:
            if done:
                break
            attempts += 1
            done = value != failure or value == last
            rows.append((key[0], attempts, value, done))
            last = value
        state.update((attempts, last, done))
        yield pd.DataFrame(rows, columns=["item", "attempt", "outcome", "terminal"])

    keyed = events.withColumn(item, F.col(item).cast("string"))
    return keyed.groupBy(item).applyInPandasWithState(step, LEDGER, STATE, "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Take what is there and stop; a restart goes on from the checkpoint."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """As run_available, in update mode: every trigger writes the groups that changed, under its number.

    A trigger that runs again after a failure overwrites its own folder, so each
    counts once; latest() reads the last state of each group, open windows too.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/trigger={number}")

    query = stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def latest(spark: SparkSession, path: str, keys: list[str], schema) -> DataFrame:
    """The last state of each group that run_updates wrote."""
    from pyspark.sql import types as T

    fields = [*schema.fields, T.StructField("trigger", T.LongType())]
    rows = spark.read.schema(T.StructType(fields)).option("basePath", path).parquet(path)
    values = [f.name for f in schema.fields if f.name not in keys]
    return rows.groupBy(*keys).agg(F.max(F.struct("trigger", *values)).alias("last")).select(*keys, *(F.col(f"last.{v}").alias(v) for v in values))


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, over all triggers that the query remembers."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def stream_table(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table, a file or a folder of part files, as a stream."""
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    single = [f for f in table.inputFiles() if f.rstrip("/").endswith("/" + path.rstrip("/").rpartition("/")[2])]
    if single:
        # the source takes folders: its folder, and only this name
        folder, _, name = path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)
