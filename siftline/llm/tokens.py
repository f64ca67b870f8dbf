"""Encoding whole batches with the tokenizers library.

The library's byte-pair model is asked once for each distinct piece of text;
splitting into pieces, finding distinct ones and gathering their ids are
array operations.  The splitting follows the two pre-tokenisers in use (byte
level with leading spaces, and lower-cased words), for characters below
U+0250.  A text with any other character goes to the library as a whole, so
that every result equals ``Tokenizer.encode`` (tested).  So does a text that
holds an added token, where those are looked for as the library does by default.
"""

from __future__ import annotations

import json
import os

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SPACE, LETTER, NUMBER, OTHER, FOREIGN = 0, 1, 2, 3, 9
#: Pieces that a worker remembers; beyond it, it starts anew.
REMEMBER = 1_200_000


def _classes(lowered: bool) -> np.ndarray:
    out = np.full(0x800, FOREIGN, np.uint8)
    for cp in range(0x250):
        ch = chr(cp)
        if lowered and len(ch.lower()) != 1:
            continue
        kinds = ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}"))
        out[cp] = next((k for k, p in kinds if regex.match(p, ch)), OTHER)
    return out


def _byte_letters() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class Encoder:
    """Whole texts to ids, equal to the tokenizer's own without special tokens.

    With added, the text of an added token is that token, the library's default;
    without, it is split as any other text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not added
        spec = json.loads(self.whole.to_str())
        self.added = [t["content"].lower().encode() for t in spec["added_tokens"]] if added else []
        self.lowered = spec["pre_tokenizer"]["type"] == "Sequence"
        self.model = self.whole.model
        self.classes = _classes(self.lowered)
        self.letters = {b: x for b, x in enumerate(_byte_letters())}
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 16, np.int64)  # begin[i + 1] is the end of piece i

    def _learn(self, pieces: list[bytes], hashes: list[int]) -> None:
        tokenize, letters, at = self.model.tokenize, self.letters, len(self.known)
        new: list[int] = []
        sizes: list[int] = []
        for piece in pieces:
            if self.lowered:
                piece = piece.decode().lower().encode()
            ids = [t.id for t in tokenize(piece.decode("latin-1").translate(letters))]
            new += ids
            sizes.append(len(ids))
        end, need = int(self.begin[at]), at + len(pieces) + 1
        while need > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        while end + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[end : end + len(new)] = new
        self.begin[at + 1 : need] = end + np.cumsum(sizes)
        self.known.update(zip(hashes, range(at, at + len(pieces)), strict=True))

    def _starts(self, d: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class of each byte, whether a piece starts there)."""
        from siftline.llm.textnum import LOWER

        n = len(d)
        nxt = np.zeros(n, np.uint8)
        nxt[:-1] = d[1:]
        point = np.where(d < 0x80, d, ((d & 0x1F).astype(np.uint16) << 6) | (nxt & 0x3F))
        kind = self.classes[point]
        kind[d >= 0xCA] = FOREIGN
        cont = (d & 0xC0) == 0x80
        at = np.flatnonzero(cont)
        kind[at] = kind[at - 1]
        start = np.ones(n, bool)
        start[1:] = kind[1:] != kind[:-1]
        edge = off[off < n]
        start[edge] = True
        row_start = np.zeros(n + 3, bool)
        row_start[edge] = True
        row_start[n:] = True
        if self.lowered:
            start |= (kind == NUMBER) & ~cont
        else:
            after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~row_start[1:n]) + 1
            last = after - 1
            blank = d[last] == 0x20
            start[last[blank]] = True
            start[after[blank]] = False
            other = last[~blank]
            start[other - cont[other]] = True
        # an apostrophe that starts a piece takes s, t, m, d, re, ve or ll with it
        low = LOWER[d] if self.lowered else d
        for q in np.flatnonzero((d == 0x27) & start):
            if q + 1 < n and not row_start[q + 1] and kind[q + 1] == LETTER:
                two = bytes(low[q + 1 : q + 3])
                size = 1 if two[:1] in (b"s", b"t", b"m", b"d") else 2 if two in (b"re", b"ve", b"ll") and not row_start[q + 2] else 0
                if size:
                    start[q + 1] = False
                    if q + 1 + size < n:
                        start[q + 1 + size] = True
        return kind, start

    def _with_added(self, data: np.ndarray) -> list[int]:
        """Where an added token may start, in any case of letters."""
        from siftline.llm.textnum import LOWER

        found, raw = [], LOWER[data].tobytes() if self.added else b""
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                found.append(at)
                at = raw.find(token, at + 1)
        return found

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of the rows) for UTF-8 rows; off[0] is 0."""
        from siftline.llm.textnum import span_hashes

        rows, n = len(off) - 1, len(data)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        kind, start = self._starts(data, off)
        begins = np.flatnonzero(start)
        ends = np.append(begins[1:], n)
        row = np.searchsorted(off, begins, "right") - 1
        foreign = np.zeros(rows, bool)
        odd = np.concatenate([np.flatnonzero(kind == FOREIGN), np.array(self._with_added(data), np.int64)])
        foreign[np.searchsorted(off, odd, "right") - 1] = True
        keep = ~foreign[row]
        if self.lowered:
            keep &= kind[begins] != SPACE
        begins, ends, row = begins[keep], ends[keep], row[keep]
        h = span_hashes(data, begins, ends)
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(uniq) > REMEMBER:
            self.forget()
        keys = uniq.tolist()
        get = self.known.get
        index = np.array([get(k, -1) for k in keys], np.int64)
        missing = np.flatnonzero(index < 0)
        if len(missing):
            raw, b, e = data.tobytes(), begins[first[missing]].tolist(), ends[first[missing]].tolist()
            at = len(self.known)
            self._learn([raw[i:j] for i, j in zip(b, e, strict=True)], [keys[i] for i in missing])
            index[missing] = np.arange(at, at + len(missing))
        size_of = self.begin[index + 1] - self.begin[index]
        sizes = size_of[inverse]
        counts = np.bincount(row, sizes, rows).astype(np.int64) if len(row) else np.zeros(rows, np.int64)
        out_end = np.cumsum(sizes)
        total = int(out_end[-1]) if len(sizes) else 0
        ids = self.flat[np.repeat(self.begin[index][inverse] - (out_end - sizes), sizes) + np.arange(total)]
        if not foreign.any():
            return ids, np.concatenate([[0], np.cumsum(counts)])
        parts, at = [], 0
        spelled = iter(self.whole.encode_batch_fast([bytes(data[off[i] : off[i + 1]]).decode() for i in np.flatnonzero(foreign)], add_special_tokens=False))
        for i in range(rows):
            if foreign[i]:
                own = np.array(next(spelled).ids, np.uint32)
                counts[i] = len(own)
            else:
                own = ids[at : at + counts[i]]
                at += counts[i]
            parts.append(own)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, added=True)
    return _encoders[path]


def with_end(ids: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each row's ids."""
    rows = len(off) - 1
    return np.insert(ids, off[1:], np.uint32(end_id)), off + np.arange(rows + 1)
