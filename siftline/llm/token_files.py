"""Token-id output: Parquet list columns that can be read selectively.

Texts are encoded in ascending doc_id order and written as Parquet files with
one list column of ids (delta or dictionary encoding), bounded row groups and
page indexes, so that a reader can fetch single columns, row groups or pages.
A writing task names its file after itself and an attempt, and only files in
the manifest count: a task that runs again leaves nothing behind that is read.

Defined cases: a null or empty text has only the end id; a null doc_id sorts
first; repeated rows are kept, equal ids in the order of their texts' hashes;
other columns are ignored; an empty table gives an empty manifest.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.llm import textnum, tokens, work

MANIFEST = "part int, row_group int, path string, n_rows long, n_tokens long"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.field("element", pa.int32())))])


def _writer(out, encoding: str, page_bytes: int) -> pq.ParquetWriter:
    dictionary = ["ids.list.element"] if encoding == "dictionary" else False
    return pq.ParquetWriter(
        out,
        SCHEMA,
        compression="zstd",
        compression_level=1,
        use_dictionary=dictionary,
        column_encoding=None if dictionary else {"doc_id": "DELTA_BINARY_PACKED", "n_tokens": "DELTA_BINARY_PACKED", "ids.list.element": "DELTA_BINARY_PACKED"},
        data_page_size=page_bytes,
        write_page_index=True,
        write_statistics=["doc_id", "n_tokens"],
    )


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end_id: int = 2, encoding: str = "dictionary", group_tokens: int = 1 << 20, page_bytes: int = 1 << 18) -> DataFrame:
    """Write documents (doc_id, text) as token files; return the manifest, one row a row group."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is dictionary or delta")
    spark = docs.sparkSession
    work.tune(spark)
    files = f"{path}/files"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = tokens.encoder(vocabulary)
        part = TaskContext.get().partitionId()
        name = f"{files}/part-{part:06d}-{uuid.uuid4().hex}.parquet"
        fs = local = out = writer = None
        held: list[pa.RecordBatch] = []
        held_tokens, rows = 0, []

        def flush() -> None:
            nonlocal held, held_tokens
            table = pa.Table.from_batches(held, SCHEMA)
            writer.write_table(table, row_group_size=max(1, table.num_rows))
            rows.append((part, len(rows), name, table.num_rows, held_tokens))
            held, held_tokens = [], 0

        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                if writer is None:
                    fs, local = work.opened(name)
                    fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
                    out = fs.open_output_stream(local, compression=None)
                    writer = _writer(out, encoding, page_bytes)
                doc_id = batch.column("doc_id").cast(pa.int64())
                data, off = textnum.column_bytes(batch.column("text"))
                for i, j in textnum.slices(off):
                    ids, at = tokens.with_end(*code.encode(data[off[i] : off[j]], off[i : j + 1] - off[i]), end_id)
                    lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                    held.append(pa.record_batch([doc_id.slice(i, j - i), pa.array(np.diff(at)), lists], schema=SCHEMA))
                    held_tokens += len(ids)
                    if held_tokens >= group_tokens:
                        flush()
            if held:
                flush()
        finally:
            if writer is not None:
                writer.close()
                out.close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["part", "row_group", "path", "n_rows", "n_tokens"])

    ordered = docs.select("doc_id", "text").repartitionByRange(work.partitions(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return work.stored(ordered.mapInArrow(write, MANIFEST), f"{path}/manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with base, the number of ids in all row groups before."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_base"))
    within = Window.partitionBy("part").orderBy("row_group").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return manifest.withColumn("own", own).join(parts, "part").withColumn("base", F.col("part_base") + F.col("own")).drop("own", "part_base")


def read_groups(manifest: DataFrame) -> DataFrame:
    """Read token files back by row group: doc_id, start, n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    work.tune(spark)
    told = with_starts(manifest).select("path", "row_group", "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, group, base in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                fs, local = work.opened(path)
                with fs.open_input_file(local) as src:
                    table = pq.ParquetFile(src).read_row_group(group, columns=["doc_id", "ids"])
                lists = table["ids"].combine_chunks()
                if isinstance(lists, pa.ChunkedArray):
                    lists = pa.concat_arrays(lists.chunks)
                off = lists.offsets.to_numpy().astype(np.int64)
                flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4"))
                crc = [zlib.crc32(flat[i:j]) for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                doc_id = table["doc_id"].combine_chunks()
                yield pa.RecordBatch.from_arrays([doc_id, pa.array(base + off[:-1] - off[0]), pa.array(np.diff(off)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = told.repartition(max(1, work.partitions(spark)), "path", "row_group")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The token table through Spark's own reader, pruned to columns."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    files = [r.path for r in manifest.select("path").distinct().collect()]  # as many as writing tasks
    if not files:
        return spark.createDataFrame([], "doc_id long, n_tokens long, ids array<int>").select(*(columns or ["doc_id", "n_tokens", "ids"]))
    return spark.read.parquet(*files).select(*(columns or ["doc_id", "n_tokens", "ids"]))
