"""Packing token sequences: first-fit decreasing over a tournament tree.

Documents are encoded and cut into pieces of at most the capacity; the pieces
go to randomised groups (a hash of document and position, so that no source or
group of copies lands together), and each group is packed by itself: pieces in
descending length, each into the first open sequence with room, found by
descending a tournament tree of remaining capacities.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed as often as they occur; ties in length go by doc_id and start (null
first); a piece of full length is a sequence of its own; an empty table gives
no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm import textnum, tokens, work

#: Pieces of a group at most, about.
GROUP_PIECES = 1 << 18
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


class TournamentTree:
    """Remaining capacities of sequences; finds the first with enough room."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> tuple[int, int]:
        """Take size from the first sequence that holds it: (sequence, room before)."""
        best, node = self.best, 1
        if best[1] < size:
            raise ValueError("no sequence has room")
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        room = best[node]
        best[node] = room - size
        found = node - self.leaves
        while node > 1:
            node //= 2
            top = max(best[2 * node], best[2 * node + 1])
            if best[node] == top:
                break
            best[node] = top
        return found, room


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length; lengths are in descending order."""
    tree = TournamentTree(max(1, len(lengths)), capacity)
    seq, off = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        seq[i], room = tree.first_fit(size)
        off[i] = capacity - room
    return seq, off


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Encode documents (doc_id, text) and cut them to pieces of at most capacity ids."""
    work.tune(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = tokens.encoder(vocabulary)
        for batch in batches:
            doc_id = batch.column("doc_id").cast(pa.int64())
            data, off = textnum.column_bytes(batch.column("text"))
            for i, j in textnum.slices(off):
                ids, at = tokens.with_end(*code.encode(data[off[i] : off[j]], off[i : j + 1] - off[i]), end_id)
                size = np.diff(at)
                count = -(-size // capacity)
                row = np.repeat(np.arange(j - i), count)
                begin = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * capacity
                length = np.minimum(size[row] - begin, capacity)
                flat = np.ascontiguousarray(ids.astype("<u4"))
                a = (at[row] + begin).tolist()
                b = (at[row] + begin + length).tolist()
                crc = [zlib.crc32(flat[x:y]) for x, y in zip(a, b, strict=True)]
                cols = [doc_id.slice(i, j - i).take(pa.array(row)), pa.array(begin), pa.array(length), pa.array(crc, pa.int64()), pa.array(size[row])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(a, len(flat)).astype(np.int32)), pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def pack(parts: DataFrame, capacity: int = 4096, group_tokens: int = 16 << 20) -> DataFrame:
    """Place pieces (PIECES, perhaps ids) into sequences: adds sequence_id and offset."""
    spark = parts.sparkSession
    parts = work.stored(parts, work.folder(spark, "pieces"))
    total, count = parts.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    groups = max(1, -(-int(total) // group_tokens), -(-count // GROUP_PIECES))
    names = parts.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"

    def place(table: pa.Table) -> pa.Table:
        group = table["pack_group"][0].as_py()
        table = table.select(names).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        seq, off = first_fit_decreasing(table["length"].to_numpy(), capacity)
        return table.append_column("sequence_id", pa.array((np.int64(group) << 32) + seq)).append_column("offset", pa.array(off))

    grouped = parts.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    return grouped.groupBy("pack_group").applyInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2, group_tokens: int = 16 << 20, with_ids: bool = False) -> DataFrame:
    """Encode, cut and pack documents; a row is a piece with its place."""
    return pack(pieces(docs, vocabulary, capacity, end_id, with_ids), capacity, group_tokens)
