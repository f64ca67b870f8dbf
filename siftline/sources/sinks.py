"""Sinks: write-once tables, append-only ledgers, private documents, static pages.

Tables go through Spark's committers, so a lost task leaves nothing visible.
Private documents and pages are small by nature and written on the driver.
"""

from __future__ import annotations

import html
import json
import os
import stat
import tempfile
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


class ConflictError(RuntimeError):
    """A key exists already with other content."""


def existing(df: DataFrame, path: str) -> DataFrame | None:
    """What the table at path holds, with df's columns, or None."""
    try:
        return df.sparkSession.read.schema(df.schema).parquet(path)
    except AnalysisException:
        return None


def content(df: DataFrame) -> DataFrame:
    return df.withColumn("content_hash", F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256))


def write_once(df: DataFrame, path: str, key: str) -> int:
    """Add the rows whose key is new; the same row again is no change, another one is an error.  Returns rows added."""
    doubled = df.groupBy(key).count().filter("count > 1").limit(1).count()
    if doubled:
        raise ConflictError("a key repeats in the input")
    before = existing(df, path)
    fresh = df
    if before is not None:
        old = content(before).select(F.col(key).alias("_key"), F.col("content_hash").alias("_hash"))
        if content(df).join(old, F.col(key) == F.col("_key")).filter("content_hash <> _hash").limit(1).count():
            raise ConflictError("a key exists with other content")
        fresh = df.join(before.select(key), key, "left_anti").select(*df.columns)
    added = fresh.count()
    if added:
        fresh.write.mode("append").parquet(path)
    return added


def append_terminal(results: DataFrame, path: str, key: str, statuses: Iterable[str]) -> None:
    """Append terminal results: known statuses only, one a key, never two."""
    if results.filter(~F.col("status").isin(*statuses) | F.col("status").isNull()).limit(1).count():
        raise ValueError("an unknown terminal status")
    before = existing(results, path)
    if before is not None and results.join(before.select(key), key, "left_semi").limit(1).count():
        raise ConflictError("a key is terminal already")
    if results.groupBy(key).count().filter("count > 1").limit(1).count():
        raise ConflictError("a key repeats in the input")
    results.write.mode("append").parquet(path)


def write_run(tables: dict[str, DataFrame], path: str) -> None:
    """The tables of a run below one path, and a receipt; an existing run is never overwritten.

    The receipt has a row a table: its rows, and a digest of what was written
    that does not depend on their order.  It is written last, so a run without
    one is not whole.
    """
    receipt = None
    for name, df in sorted(tables.items()):
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
        kept = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")
        body = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(kept.columns))))
        digest = F.sha2(F.concat_ws(":", F.coalesce(F.bit_xor(F.xxhash64(body)), F.lit(0)), F.coalesce(F.sum(F.crc32(body.cast("binary"))), F.lit(0)), F.count(F.lit(1))), 256)
        own = kept.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"), digest.alias("digest"))
        receipt = own if receipt is None else receipt.unionByName(own)
    if receipt is not None:
        receipt.coalesce(1).write.mode("errorifexists").json(f"{path}/receipt")


def private_folder(path: str) -> str:
    """A folder of this user alone; links and foreign folders are refused."""
    os.makedirs(path, mode=0o700, exist_ok=True)
    info = os.lstat(path)
    if stat.S_ISLNK(info.st_mode) or info.st_uid != os.geteuid():
        raise ValueError("not a private folder")
    os.chmod(path, 0o700)
    return path


def private_document(path: str, value) -> None:
    """Write canonical JSON, or text, at once and for the owner only."""
    body = value if isinstance(value, str) else json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n"
    folder = private_folder(os.path.dirname(os.path.abspath(path)))
    handle, temp = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(body)
            f.flush()
            os.fsync(f.fileno())
        os.chmod(temp, 0o600)
        os.replace(temp, path)
    except BaseException:
        if os.path.exists(temp):
            os.unlink(temp)
        raise


_PAGE = """<!doctype html><html><head><meta charset="utf-8"><title>{title}</title></head><body><h1>{title}</h1>
<input id="q" placeholder="Search"><select id="t"><option value="">All topics</option>{topics}</select><main>{cards}</main>
<script>const q=document.getElementById("q"),t=document.getElementById("t");function show(){{const s=q.value.toLowerCase();
for(const c of document.querySelectorAll("article"))c.hidden=!(c.textContent.toLowerCase().includes(s)&&(!t.value||c.dataset.topic===t.value))}}
q.oninput=t.onchange=show</script></body></html>
"""


def page(rows: list[dict], title: str, fields: tuple[str, ...]) -> str:
    """A static page of reviewed rows with a text and a topic filter; every value is escaped."""
    safe = lambda v: html.escape(str(v), quote=True)
    cards = "".join(f'<article data-topic="{safe(r["topic"])}">' + "".join(f"<p>{safe(r[f])}</p>" for f in fields) + "</article>" for r in rows)
    topics = "".join(f'<option value="{safe(x)}">{safe(x)}</option>' for x in sorted({r["topic"] for r in rows}))
    return _PAGE.format(title=safe(title), topics=topics, cards=cards)
