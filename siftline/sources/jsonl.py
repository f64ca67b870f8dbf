"""JSON-lines source: discovery guards, bounded lines, and parse accounting.

Lines end at a line feed only.  Whether a line is JSON follows the strictness
of Python's parser (trailing text is an error, the last duplicate key counts),
which no built-in expression has, so parsing runs in Arrow batches, and the
same parse gives the few typed values that the census needs; all else is
expressions.
"""

from __future__ import annotations

import json
import os
import stat
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.functions import lexicons as L

LINES = "harness string, path string, line_no long, bytes long, state string, canonical string, type string, stamp string, ts timestamp, own map<string,string>, inner map<string,string>, side array<boolean>"
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


@dataclass
class Discovery:
    """Files under local roots with what they looked like, and what was refused, with the reason."""

    files: list[tuple[str, str]] = field(default_factory=list)  # (harness, path)
    refused: list[tuple[str, str, str]] = field(default_factory=list)  # (harness, path, reason)
    seen: dict[str, tuple] = field(default_factory=dict)  # by path: device, inode, size, times
    unreadable: int = 0  # folders

    def artifacts(self, spark: SparkSession, changed: dict[str, str] | None = None) -> DataFrame:
        """(harness, path, fault): every file found or refused; changed has faults found later, by path."""
        changed = changed or {}
        rows = [(h, p, changed.get(p)) for h, p in self.files] + [(h, p, r) for h, p, r in self.refused]
        return spark.createDataFrame(rows, "harness string, path string, fault string")

    def changes(self) -> dict[str, str]:
        """Faults of files that are no longer what they were when they were found; ask after reading."""
        out = {}
        for path, before in self.seen.items():
            try:
                if _identity(os.lstat(path)) != before:
                    out[path] = "source_changed_during_read"
            except OSError:
                out[path] = "source_read_failed"
        return out


def _identity(info: os.stat_result) -> tuple:
    return info.st_dev, info.st_ino, info.st_size, info.st_mtime_ns, info.st_ctime_ns


def refusal(path: str, root: str) -> tuple[str | None, os.stat_result | None]:
    """(why a file must not be read, or null; what it looks like): links are not followed, the open file is what was listed."""
    try:
        before = os.lstat(path)
    except OSError:
        return "source_unstatable", None
    if stat.S_ISLNK(before.st_mode):
        return "symlink_rejected", None
    if not stat.S_ISREG(before.st_mode):
        return "special_file_rejected", None
    try:
        inside = os.path.commonpath([os.path.realpath(root, strict=True), os.path.realpath(path, strict=True)])
    except (OSError, ValueError):
        return "source_path_unresolvable", None
    if inside != os.path.realpath(root):
        return "source_path_outside_root", None
    try:
        handle = os.open(path, os.O_RDONLY | os.O_NOFOLLOW)
    except OSError:
        return "source_open_failed", None
    try:
        info = os.fstat(handle)
    except OSError:
        return "descriptor_check_failed", None
    finally:
        os.close(handle)
    if not stat.S_ISREG(info.st_mode):
        return "special_file_rejected", None
    if info.st_uid != os.getuid():
        return "unsafe_source_owner", None
    if (info.st_dev, info.st_ino) != (before.st_dev, before.st_ino):
        return "descriptor_mismatch", None
    return None, info


def check_root(root: str) -> None:
    """A root is a real directory of this user."""
    info = os.lstat(root)
    if stat.S_ISLNK(info.st_mode) or not stat.S_ISDIR(info.st_mode):
        raise ValueError("the root is not a plain directory")
    if info.st_uid != os.geteuid():
        raise ValueError("the root belongs to another user")


def discover(roots: dict[str, str]) -> Discovery:
    """Regular *.jsonl files below each root, by relative path; links are never followed.  Local roots only."""
    out = Discovery()
    for harness, root in sorted(roots.items()):
        check_root(root)
        found = []

        def lost(_: OSError) -> None:
            out.unreadable += 1

        for folder, names, files in os.walk(root, onerror=lost):
            names[:] = [n for n in names if not os.path.islink(os.path.join(folder, n))]
            found += [os.path.join(folder, f) for f in files if f.endswith(".jsonl")]
        for path in sorted(found, key=lambda p: os.path.relpath(p, root)):
            why, info = refusal(path, root)
            if why:
                out.refused.append((harness, path, why))
            else:
                out.files.append((harness, path))
                out.seen[path] = _identity(info)
    return out


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def moment(value) -> datetime | None:
    """A JSON value as a time: a number of seconds, or of milliseconds from 1e11 on, or ISO-8601 text with an offset."""
    if isinstance(value, bool):
        return None
    try:
        if isinstance(value, (int, float)):
            seconds = float(value)
            found = _EPOCH + timedelta(seconds=seconds / 1000 if abs(seconds) >= 1e11 else seconds)
        elif isinstance(value, str):
            found = datetime.fromisoformat(value.replace("Z", "+00:00"))
        else:
            return None
        return found.astimezone(UTC) if found.tzinfo else None
    except (OverflowError, ValueError):
        return None


def plain(value) -> str | None:
    """Text that is not blank, or a number, as text."""
    if isinstance(value, str):
        return value.strip() or None
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return str(value)
    return None


def _picked(holder, keys: tuple[str, ...]) -> dict[str, str]:
    if not isinstance(holder, dict):
        return {}
    got = ((k, plain(holder.get(k))) for k in keys)
    return {k: v for k, v in got if v is not None}


def _classify(raw: str | None, size: int, limit: int) -> tuple:
    """(state, canonical, type, stamp, ts, own, inner, side) of a line."""
    if raw is None or size > limit:
        return "oversized", *[None] * 7
    if not raw.strip():
        return "blank", *[None] * 7
    try:
        value = json.loads(raw)
        canonical = canonical_json(value)
        canonical.encode()
    except (ValueError, RecursionError):
        return "malformed", *[None] * 7
    if not isinstance(value, dict):
        return "malformed", *[None] * 7
    inner = value.get("payload")
    kind, ts = value.get("type"), moment(value.get("timestamp"))
    stamp = "missing" if "timestamp" not in value else "invalid" if ts is None else "valid"
    # the record's own value counts where the key is there at all
    flags = (value[k] if k in value else inner.get(k) if isinstance(inner, dict) else None for k in L.SIDECHAIN_KEYS)
    return "parsed", canonical, kind if isinstance(kind, str) else None, stamp, ts, _picked(value, L.RECORD_KEYS), _picked(inner, L.PAYLOAD_KEYS), [f for f in flags if isinstance(f, bool)]


def parse_lines(lines: DataFrame, limit: int = L.MAX_RECORD_BYTES) -> DataFrame:
    """(harness, path, line_no, raw, bytes) to LINES: state blank, oversized, malformed or parsed, and what the census needs."""
    names = ("state", "canonical", "type", "stamp", "ts", "own", "inner", "side")
    bounded = lines.select("harness", "path", "line_no", F.when(F.col("bytes") <= limit, F.col("raw")).alias("raw"), "bytes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [_classify(r, b, limit) for r, b in zip(pdf["raw"], pdf["bytes"], strict=True)]
            out = pdf.drop(columns="raw").assign(**{n: pd.Series([g[i] for g in got], index=pdf.index, dtype=object) for i, n in enumerate(names) if n != "ts"})
            yield out.assign(ts=pd.to_datetime(pd.Series([g[4] for g in got], index=pdf.index, dtype=object), utc=True).astype("datetime64[us, UTC]"))

    return bounded.mapInPandas(run, LINES)


def read_lines(spark: SparkSession, paths: dict[str, str | list[str]], limit: int = L.MAX_RECORD_BYTES) -> DataFrame:
    """Lines of JSONL files by harness, as LINES.

    Files are split like any text.  A line's number is its place in its block,
    which one pass over the block counts, and the lines of the blocks before;
    lines themselves are not shuffled, and longer ones than the limit not kept.
    """
    out = None
    for harness, where in sorted(paths.items()):
        text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(where, lineSep="\n")
        text = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
        before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = text.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"))  # a row a block, not a line
        blocks = blocks.select("path", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
        sized = text.select("path", "block", F.octet_length("value").cast("long").alias("bytes"), F.when(F.octet_length("value") <= limit, F.col("value")).alias("raw"))
        placed = sized.mapInArrow(_place, "path string, block long, bytes long, raw string, place long").join(blocks, ["path", "block"])
        lines = placed.select(F.lit(harness).alias("harness"), "path", (F.col("first") + F.col("place")).alias("line_no"), "raw", "bytes")
        out = lines if out is None else out.unionByName(lines)
    return parse_lines(out, limit)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each block, which follow one another in a task."""
    own, at = None, 0
    for batch in batches:
        places = []
        for key in zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), strict=True):
            own, at = (own, at + 1) if key == own else (key, 0)
            places.append(at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=[*batch.schema.names, "place"])
