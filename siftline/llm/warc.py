"""WARC files: a writer with revisit records, and a splittable reader.

Every record is a gzip member of its own.  The reader deals byte ranges of the
files to tasks.  A task scans its range for the gzip magic, takes the first
candidate whose member inflates to a record header, and from there walks from
member to member; it owns the records that start inside its range, the last of
which it reads beyond the end.

Of records with equal payloads of at least ``min_bytes``, that with the
largest page id is a response and the others are revisits that refer to it.

Defined cases: a null html is an empty payload; a null url or page_id is
written as an absent header and read back as null (a null page_id sorts below
all others); repeated rows with the largest id are all responses, and one
record written several times; an empty table writes no files; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm import textnum, work

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a split of the reader, and of one read.
SPLIT_BYTES, READ_BYTES = 8 << 20, 1 << 20
#: Payloads with more than this part of all pages are marked by broadcast; there are fewer than that.
LARGE = 1000
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, path string, offset long"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int, digest: str) -> str:
    """The id of the response of a page, which its revisits name too."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, place: str = "") -> bytes:
    """One record with its block, uncompressed; place tells records apart that have no id of a page, or are revisits."""
    digest = digest32(payload)
    own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place}:{page_id}:{digest}')}>" if revisit or page_id is None else record_id(page_id, digest)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {own}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n%]", lambda m: f"%{ord(m[0]):02X}", url))
    block = payload
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        head.append(f"X-Refers-To-Page: {refers_to}")
        block = b""
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 5) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse(raw: bytes) -> dict | None:
    """The record in an inflated member, or None if it isn't a whole one."""
    if not raw.startswith(b"WARC/1."):
        return None
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap:
        return None
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    size = fields.get("Content-Length", "")
    if not size.isdigit() or len(rest) < int(size):
        return None
    return {k.lower(): v for k, v in fields.items()} | {"block": rest[: int(size)]}


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, html) with refers_to: the response's id, or null."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("key"))
    groups = pages.select(F.col("page_id").cast("long").alias("page_id"), payload.alias("payload")).filter(F.octet_length("payload") >= min_bytes)
    groups = groups.groupBy(F.sha1("payload").alias("g_key")).agg(F.max("page_id").alias("g_last"), F.min("page_id").alias("g_first"), F.count(F.lit(1)).alias("n"), F.count("page_id").alias("known"))
    # only payloads that differ in page, joined by digest: a payload of many pages by broadcast, so that they stay where they are
    groups = groups.filter((F.col("g_last") != F.col("g_first")) | ((F.col("known") < F.col("n")) & (F.col("known") > 0))).select("g_key", "g_last", "n")
    groups = work.stored(groups, work.folder(pages.sparkSession, "digests"))
    least = pages.count() // LARGE
    often = F.broadcast(groups.filter(F.col("n") > least).limit(LARGE))  # fewer than LARGE payloads have more than 1/LARGE of the pages each
    seldom = keyed.join(often.select("g_key"), F.col("key") == F.col("g_key"), "left_anti").join(groups.filter(F.col("n") <= least), F.col("key") == F.col("g_key"), "left")
    joined = keyed.join(often, F.col("key") == F.col("g_key")).unionByName(seldom)
    other = F.col("g_last").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("g_last")))
    return joined.select("page_id", "url", "payload", F.when(other, F.col("g_last")).alias("refers_to"))


def write_warc(marked: DataFrame, path: str) -> DataFrame:
    """Write records (page_id, url, payload, refers_to); return the manifest of files."""
    work.tune(marked.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{path}/files/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, size, count = None, 0, 0
        try:
            for batch in batches:
                for page_id, url, payload, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                    if out is None:
                        fs, local = work.opened(name)
                        fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
                        out = fs.open_output_stream(local, compression=None)
                    raw = member(record(page_id, url, payload, refers, refers is not None, f"{name}:{count}"))
                    out.write(raw)
                    size, count = size + len(raw), count + 1
        finally:
            if out is not None:
                out.close()
        if count:
            yield pa.RecordBatch.from_pydict({"path": [name], "bytes": [size], "records": [count]})

    return work.stored(marked.mapInArrow(write, "path string, bytes long, records long"), f"{path}/manifest")


class _Window:
    """Bytes of a file from some place on, read as they are wanted."""

    def __init__(self, src, at: int, size: int):
        self.src, self.base, self.size, self.held = src, at, size, b""
        src.seek(at)

    def more(self) -> bool:
        got = self.src.read(READ_BYTES) if self.base + len(self.held) < self.size else b""
        self.held += got
        return bool(got)

    def drop(self, at: int) -> None:
        self.held = self.held[at - self.base :]
        self.base = at


def _inflate(win: _Window, at: int, header_only: bool = False) -> tuple[bytes, int] | None:
    """(contents, end) of the gzip member at a place, or None if none is there."""
    z, out, pos = zlib.decompressobj(31), [], at
    try:
        while not z.eof:
            if pos - win.base >= len(win.held) and not win.more():
                return None
            chunk = win.held[pos - win.base :]
            out.append(z.decompress(chunk))
            pos += len(chunk)
            if header_only and sum(map(len, out)) >= 7 and not b"".join(out).startswith(b"WARC/1."):
                return None
    except zlib.error:
        return None
    return b"".join(out), pos - len(z.unused_data)


def scan(src, size: int, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """Records that start in [start, end) of a file."""
    win, at, found = _Window(src, start, size), start, False
    while at < end:
        if not found:
            hit = win.held.find(MAGIC, at - win.base)
            if hit < 0:
                # keep the last two bytes: a magic may lie across two reads
                at = max(at, win.base + len(win.held) - 2)
                win.drop(min(at, win.base + len(win.held)))
                if not win.more():
                    return
                continue
            at = win.base + hit
            if at >= end:
                return
        got = _inflate(win, at, header_only=not found)
        rec = parse(got[0]) if got else None
        if rec is None:
            found, at = False, at + 1
            continue
        yield at, rec
        found, at = True, got[1]
        win.drop(at)
        if at >= size:
            return


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the files in manifest (path, bytes)."""
    spark = manifest.sparkSession
    work.tune(spark)
    splits = manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest((F.col("bytes") - 1).bitwiseAND(F.lit(~(split_bytes - 1))), F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    splits = splits.repartition(work.partitions(spark), "path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64()]
        for batch in batches:
            for path, size, start in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rows: list[tuple] = []
                held = 0
                fs, local = work.opened(path)
                with fs.open_input_file(local) as src:
                    for offset, rec in scan(src, size, start, start + split_bytes):
                        kind, block = rec["warc-type"], rec["block"]
                        refers = int(rec["x-refers-to-page"]) if kind == "revisit" else None
                        url = rec.get("warc-target-uri")
                        url = re.sub(r"%(0D|0A|25)", lambda m: chr(int(m[1], 16)), url) if url is not None else None
                        page = int(rec["x-page-id"]) if "x-page-id" in rec else None
                        whole = kind == "response"
                        rows.append((page, url, kind, refers, len(block) if whole else int(rec["x-payload-length"]), digest32(block) if whole else rec["warc-payload-digest"][5:], block, path, offset))
                        held += len(block)
                        if held > textnum.SLICE_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    assert split_bytes & (split_bytes - 1) == 0 and np.int64(split_bytes) > 0
    return splits.mapInArrow(read, RECORDS)
