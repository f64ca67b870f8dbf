"""Whole-batch text work in numpy: word spans, rolling hashes, shingles.

Everything here takes the raw UTF-8 bytes of an Arrow string column, so a
batch of documents is one byte array plus row offsets.  Words are maximal
runs of bytes outside 0x20 and 0x09-0x0D.  Nothing is cut off: a text that
is longer than a slice makes a slice of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MULT = 0x9E3779B97F4A7C15
_U = np.uint64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """m**i and m**-i modulo 2**64 for i <= n; m is odd and so invertible."""
    global _powers
    if _powers is None or len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 4096)
        tables = []
        for base in (_MULT, pow(_MULT, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers = (tables[0], tables[1])
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    h = h ^ (h >> _U(31))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(29))
    h = h * _U(0xA0761D6478BD642F)
    return h ^ (h >> _U(32))


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4).astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of at most limit bytes, or of one row."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of each word; off[0] is 0."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    space = IS_SPACE[data]
    word = ~space
    first, last = word.copy(), word.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    edge = off[(off > 0) & (off < n)]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes anywhere."""
    n = len(data)
    if n == 0 or len(starts) == 0:
        return np.zeros(len(starts), np.uint64)
    up, down = _power_tables(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((LOWER[data] if lower else data).astype(np.uint64) * up[:n] + up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _U(0x8CB92BA72F3D8DD7))


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, row = word_spans(data, off)
    return span_hashes(data, starts, ends, lower), row


_STEP = np.array([pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64) for k in range(16)], np.uint64)


def ngram_hashes(words: np.ndarray, row: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that stay within a row, and their rows.

    With short, a row of fewer than n words has one n-gram of all its words.
    """
    size = len(words)
    if size == 0:
        return words, row
    total = words * _STEP[0]
    whole = np.ones(size, bool)
    for k in range(1, n):
        same = np.zeros(size, bool)
        same[: size - k] = row[k:] == row[: size - k]
        part = np.zeros(size, np.uint64)
        part[: size - k] = words[k:] * _STEP[k]
        total = total + np.where(same, part, _U(0))
        whole = same
    if short:
        head = np.ones(size, bool)
        head[1:] = row[1:] != row[:-1]
        whole = whole | head
    return mix(total[whole]), row[whole]


def distinct_by_row(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, with offsets of the rows."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(rows + 1))
