"""Census of artifacts: half-open event window, counters, identity, status, summary.

Everything is one scan with conditional aggregates by artifact; parents are a
join on a key that is made unique first.  Ordered content (hashes, first seen)
uses line numbers, never the order of arrival.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siftline.functions import ids
from siftline.functions import lexicons as L


def in_window(ts: Column, start: Column, cutoff: Column) -> Column:
    """Half-open: start <= ts < cutoff; null is outside."""
    return F.coalesce((ts >= start) & (ts < cutoff), F.lit(False))


def window_filter(ts: Column, start: Column, cutoff: Column) -> Column:
    """The half-open window as a filter: bare comparisons, which reach the Parquet scan."""
    return (ts >= start) & (ts < cutoff)


def in_closed_window(ts: Column, start: Column, cutoff: Column) -> Column:
    """The probe's window, closed at the cutoff."""
    return F.coalesce(ts.between(start, cutoff), F.lit(False))


def known_type(harness: Column, kind: Column, known: dict[str, tuple[str, ...]] = L.KNOWN_TYPES) -> Column:
    out = F.lit(False)
    for name, kinds in known.items():
        out = F.when(harness == name, kind.isin(*kinds)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 with an offset, or epoch seconds or milliseconds (from 1e11 on); else null."""
    number = text.try_cast("double")
    seconds = F.when(F.abs(number) >= 1e11, number / 1000).otherwise(number)
    numeric = F.when(F.abs(seconds) < 2.5e11, F.timestamp_micros(F.round(seconds * 1_000_000).cast("long")))
    iso = F.when(F.regexp_like(text, F.lit(r"(?:Z|[+-]\d\d:?\d\d)$")), F.try_to_timestamp(text))
    return F.when(number.isNotNull(), numeric).otherwise(iso)


def single_value(col: str) -> Column:
    """The one distinct value of a group, or the unknown mark."""
    return F.when(F.count_distinct(F.col(col)) == 1, F.min(col).cast("string")).otherwise(ids.UNKNOWN)


def first_seen(value: str, order: str) -> tuple[Column, Column]:
    """(the first value by order, the sorted other values) of a group."""
    first = F.min_by(value, order)
    return first, F.array_sort(F.array_except(F.collect_set(value), F.array(first)))


def terminal_status(read_failed: Column, changed: Column, oversized: Column, malformed: Column, events: Column) -> tuple[Column, Column]:
    """(status, reason); what comes first wins."""
    status = F.when(read_failed, "failed").when(changed | (oversized > 0) | (malformed > 0), "quarantined").when(events > 0, "complete").otherwise("excluded")
    reason = (
        F.when(read_failed, "source_read_failed").when(changed, "source_changed_during_read").when(oversized > 0, "record_too_large").when(malformed > 0, "malformed_jsonl").when(events > 0, F.lit(None)).otherwise("no_in_window_events")
    )
    return status, reason


def content_hash(df: DataFrame, keys: list[str], order: list[str], line: Column) -> DataFrame:
    """SHA-256 over the lines of each group in order, each with a newline.

    One pass over sorted rows feeds the running hash of a group, so no group is held.
    """
    rows = df.select(*keys, *order, line.alias("__line")).repartition(*keys).sortWithinPartitions(*keys, *order)
    kept = StructType([*(rows.schema[k] for k in keys), StructField("content_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = None, None

        def told(done: list) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays([*(pa.array(c, types[k]) for k, c in zip(keys, columns, strict=False)), pa.array(columns[-1], pa.string())], names=[*keys, "content_sha256"])

        for batch in batches:
            types, done = {k: batch.column(k).type for k in keys}, []
            for key, value in zip(zip(*(batch.column(k).to_pylist() for k in keys), strict=True), batch.column("__line").to_pylist(), strict=True):
                if state is None or key != own:
                    if state is not None:
                        done.append((*own, state.hexdigest()))
                    own, state = key, hashlib.sha256()
                if value is not None:
                    state.update(value.encode() + b"\n")
            if done:
                yield told(done)
        if state is not None:
            yield told([(*own, state.hexdigest())])

    return rows.mapInArrow(run, kept)


def status_summary(status: DataFrame, group: str, total: str = "all") -> DataFrame:
    """Counts of every terminal status (zero-filled) by group and in all, with what is unaccounted for."""
    cells = [F.count_if(F.col("status") == s).alias(s) for s in L.TERMINAL_STATUSES]
    out = status.rollup(group).agg(F.grouping(group).alias("whole"), F.count(F.lit(1)).alias("artifacts"), *cells)
    accounted = sum((F.col(s) for s in L.TERMINAL_STATUSES[1:]), F.col(L.TERMINAL_STATUSES[0]))
    return out.select(F.when(F.col("whole") == 1, total).otherwise(F.coalesce(F.col(group).cast("string"), F.lit(ids.UNKNOWN))).alias(group), "artifacts", *L.TERMINAL_STATUSES, (F.col("artifacts") - accounted).alias("unaccounted"))


def resolve_parents(children: DataFrame, parents: DataFrame, reference: str, key: str, ident: str) -> DataFrame:
    """children with parent_id: the one parent whose key is the reference, null for none or several."""
    unique = parents.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.min(ident).alias("parent_id")).filter("_n = 1").drop("_n")
    return children.join(unique, F.col(reference) == F.col("_key"), "left").drop("_key")


def working_directory(path: Column, project: str) -> tuple[Column, Column]:
    """(category, rule) of a working directory."""
    value = F.replace(F.lower(path), F.lit("\\"), F.lit("/"))
    tests = F.contains(value, F.lit("/tests")) | F.contains(value, F.lit("/test/"))
    cases = ((tests, "synthetic_test", "cwd:tests"), (F.contains(value, F.lit(project)), "project", "cwd:project"), (F.contains(value, F.lit("/documents/")), "documents", "cwd:documents"))
    kind, rule = F.when(value.isNull(), "unknown"), F.when(value.isNull(), ids.UNKNOWN)
    for test, k, r in cases:
        kind, rule = kind.when(test, k), rule.when(test, r)
    return kind.otherwise("other"), rule.otherwise("cwd:other")


def execution_shape(entry: Column, session: Column, directory: Column) -> tuple[Column, Column]:
    """(shape, provenance)."""
    seen = F.lower(F.concat_ws(" ", F.when(entry != ids.UNKNOWN, entry), F.when(session != ids.UNKNOWN, session)))
    interactive = F.contains(seen, F.lit("cli")) | F.contains(seen, F.lit("interactive")) | F.contains(seen, F.lit("terminal"))
    shape = F.when(F.contains(seen, F.lit("sdk")), "sdk").when(interactive, "interactive").when(directory == "synthetic_test", "synthetic_test").otherwise("unknown")
    provenance = F.when(F.contains(seen, F.lit("sdk")) | interactive, "observed").when(directory == "synthetic_test", "inferred").otherwise("unknown")
    return shape, provenance


def source_kind(parent: Column, sidechain: Column) -> Column:
    return F.when(sidechain.eqNullSafe(True) | (F.coalesce(parent, F.lit(ids.UNKNOWN)) != ids.UNKNOWN), "child_agent").when(sidechain.eqNullSafe(False), "root_conversation").otherwise("unknown")


def delta(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """One row: how many keys were added, removed, changed, unchanged between scans."""
    a, b = before.select(F.col(key).alias("k"), F.col(value).alias("v")), after.select(F.col(key).alias("k"), F.col(value).alias("w"))
    both = a.withColumn("in_a", F.lit(True)).join(b.withColumn("in_b", F.lit(True)), "k", "full_outer")
    here, there = F.col("in_a").isNotNull(), F.col("in_b").isNotNull()
    same = F.col("v").eqNullSafe(F.col("w"))
    return both.agg(
        F.count_if(~here & there).alias("added"), F.count_if(here & ~there).alias("removed"), F.count_if(here & there & ~same).alias("changed"), F.count_if(here & there & same).alias("unchanged")
    )


def chain_breaks(ledger: DataFrame, partition: list[str], sequence: str, own: str, previous: str) -> DataFrame:
    """Ledger rows with chain_ok: sequence counts from 1 and previous is the hash of the row before."""
    w = Window.partitionBy(*partition).orderBy(sequence)
    before = F.coalesce(F.lag(own).over(w), F.lit(""))
    return ledger.withColumn("chain_ok", (F.row_number().over(w) == F.col(sequence)) & (before == F.col(previous)))
