"""Media columns: documents stored as progressive JPEG, read back as tensors.

``store_media`` turns each whole text into one image whose coefficients are
the text's bytes, and writes a Parquet table of images.  ``decode_media``
reads images, gathers the coefficients of all scans, and gives the payload,
features of the full-resolution RGB tensor and, with ``tensors``, the tensor.

Defined cases: a null or empty text is one block of 64 zero bytes; a null
doc_id is carried along; repeated rows are stored once each, equal texts
alike; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftline.llm import progressive, textnum, work

STORED = "doc_id long, n_bytes long, payload_bytes long, media binary"
DECODED = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, height int, width int"


def store_media(docs: DataFrame, path: str) -> DataFrame:
    """Write (doc_id, text) as a table of images at path; return that table."""
    work.tune(docs.sparkSession)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column("doc_id").cast(pa.int64())
            data, off = textnum.column_bytes(batch.column("text"))
            for i, j in textnum.slices(off):
                sizes = np.diff(off[i : j + 1])
                padded = np.maximum(-(-sizes // 64) * 64, 64)
                media = [progressive.encode_payload(data[a:b].tobytes().ljust(n, b"\0")) for a, b, n in zip(off[i:j].tolist(), off[i + 1 : j + 1].tolist(), padded.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([doc_id.slice(i, j - i), pa.array(sizes), pa.array(padded), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "payload_bytes", "media"])

    return work.stored(docs.select("doc_id", "text").mapInArrow(store, STORED), path)


def tensor_feature(tensor: np.ndarray) -> str:
    """Mean and spread of each channel and of four quarters, in whole numbers."""
    h, w, _ = tensor.shape
    flat = tensor.reshape(-1, 3)
    n = len(flat)
    total = flat.sum(0, dtype=np.int64)
    wide = flat.astype(np.float32)  # sums of squares of bytes are exact in doubles
    square = [float(np.dot(wide[:, c].astype(np.float64), wide[:, c].astype(np.float64))) for c in range(3)]
    quarters = [int(q.sum(dtype=np.int64)) * 1000 // max(q.size, 1) for half in (tensor[: h // 2], tensor[h // 2 :]) for q in (half[:, : w // 2], half[:, w // 2 :])]
    return f"{w}x{h}|" + ",".join(str(int(t) * 1000 // n) for t in total) + "|" + ",".join(str((int(s) * n - int(t) ** 2) // (n * n)) for s, t in zip(square, total, strict=True)) + "|" + ",".join(map(str, quarters))


def decode_media(stored: DataFrame, tensors: bool = False) -> DataFrame:
    """Images (STORED) to payload digests, features and perhaps rgb (height * width * 3 bytes)."""
    work.tune(stored.sparkSession)
    names = [x.split()[0] for x in DECODED.split(", ")] + ["rgb"] * tensors
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32()] + [pa.binary()] * tensors

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, n_bytes, size, media in zip(*(batch.column(c) for c in ("doc_id", "n_bytes", "payload_bytes", "media")), strict=True):
                raw = media.as_py()
                image = progressive.decode(raw)
                payload = progressive.stored_payload(image, size.as_py())
                tensor = progressive.rgb(image)
                rows.append((doc_id.as_py(), n_bytes.as_py(), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(raw), hashlib.sha256(raw).hexdigest(), tensor_feature(tensor), tensor.shape[0], tensor.shape[1], *([tensor.tobytes()] if tensors else [])))
                held += tensor.nbytes if tensors else 0
                if held > 4 * textnum.SLICE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return stored.select("doc_id", "n_bytes", "payload_bytes", "media").mapInArrow(decode, DECODED + (", rgb binary" if tensors else ""))
