"""Greedy, order-keeping packing of sized items within one group.

Greedy packing is not algebraic: an item's packet depends on all before it.
Rows are dealt by group and sorted, and one pass carries the fill of the open
packet from row to row, across Arrow batches: linear in the rows, and no group
is ever held whole.  Groups run in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def greedy(df: DataFrame, keys: list[str], order: list[str], size: Column, limit: int, carry: list[str] | None = None) -> DataFrame:
    """Add packet (1-based) per group: a new one where size would pass the limit.

    Rows of more than the limit get a packet of their own and overflow is true.
    """
    names = [*keys, *order, "size", *(carry or [])]
    rows = df.select(*keys, *order, size.cast("long").alias("size"), *(carry or []))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, *order)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, packet, used = None, 0, 0
        for batch in batches:
            owners = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            packets = []
            for owner, n in zip(owners, batch.column("size").to_pylist(), strict=True):
                n = n or 0
                if owner != group or packet == 0:
                    group, packet, used = owner, 1, 0
                if used > 0 and used + n > limit:
                    packet, used = packet + 1, 0
                used += n
                packets.append(packet)
            over = [n is not None and n > limit for n in batch.column("size").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packets, pa.int32()), pa.array(over, pa.bool_())], names=[*names, "packet", "overflow"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", packet int, overflow boolean"
    return rows.mapInArrow(walk, schema)


def reserved_batches(items: DataFrame, harness: str, order: list[str], payload: str, cap: int, reserve: int, carry: list[str] | None = None) -> DataFrame:
    """Call batches by harness whose list of payloads, as JSON, leaves the reserve for prompt and calibration free.

    An item that does not fit closes the open batch and starts the next without
    being measured alone; only a harness whose first item is too large is an error.
    """
    room = cap - reserve
    if room <= 0:
        raise ValueError("prompt and calibration leave no room")
    frame = len('{"work_items":[]}') - 1  # the last item has no comma
    packed = greedy(items, [harness], order, F.octet_length(payload) + 1, room - frame, carry)
    first = packed.groupBy(harness).agg(F.min_by("overflow", F.struct(*order)).alias("over")).filter("over")
    if (bad := first.first()) is not None:
        raise ValueError(f"the first item of {bad[0]} exceeds the cap")
    return packed.withColumnRenamed("packet", "batch")


def prefix_that_fits(df: DataFrame, keys: list[str], order: list[str], size: Column, limit: int) -> DataFrame:
    """The longest prefix of each ordered group whose sizes sum to at most the limit."""
    running = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("running_bytes", F.sum(size).over(running)).filter(F.col("running_bytes") <= limit)
