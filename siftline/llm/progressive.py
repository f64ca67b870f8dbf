"""Progressive JPEG in numpy: scans accumulated into coefficient arrays.

The decoder takes any progressive file with 8-bit samples: DC and AC scans,
first passes and refinements (spectral selection and successive
approximation), end-of-band runs, restart markers, interleaved components and
any sampling factors.  Coefficients are gathered over all scans, transformed
back by one matrix product, chroma is upsampled, and the result is a
full-resolution RGB array.

The writer stores bytes losslessly: 64 bytes are the 64 quantised coefficients
of a block (a byte becomes a value of magnitude 2 to 129, see ``VALUES``), in
a 4:2:0 image with eight scans.  Its Huffman tables give a value of s bits a
code of w - s bits, so that every word of a scan has the same width w.  Any
decoder can read that; this one sees the fixed width and reads a whole scan as
one array.  Scans without that property are read symbol by symbol.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np


def _zigzag() -> np.ndarray:
    cells = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([8 * y + x for y, x in cells])


ZIGZAG = _zigzag()
_byte = np.arange(256)
#: Coefficient of each stored byte, and back (index value + 129).
VALUES = np.where(_byte < 128, _byte - 129, _byte - 126).astype(np.int16)
_BYTES = np.zeros(259, np.uint8)
_BYTES[VALUES + 129] = _byte


def _basis() -> np.ndarray:
    k = np.arange(8)
    c = np.cos((2 * k[None, :] + 1) * k[:, None] * math.pi / 16) / 2
    c[0] /= math.sqrt(2)
    return np.einsum("ux,vy->uvxy", c, c).reshape(64, 64).astype(np.float32)


BASIS = _basis()


def _fixed_codes(width: int, sizes: range) -> tuple[list[int], list[int]]:
    """(counts by code length 1..16, symbols) where size s has a code of width - s."""
    counts, symbols = [0] * 16, []
    for s in sorted(sizes, reverse=True):
        counts[width - s - 1] += 1
        symbols.append(s)
    return counts, symbols


def _code_table(counts: list[int] | bytes, symbols: list[int] | bytes) -> list[tuple[int, int, int]]:
    """(length, code, symbol) in canonical order."""
    out, code, at = [], 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((length, code, symbols[at]))
            code, at = code + 1, at + 1
        code <<= 1
    return out


@lru_cache(512)
def _parsed_table(counts: bytes, symbols: bytes) -> list[tuple[int, int, int]]:
    return _code_table(counts, symbols)


def _magnitude(v: int, s: int) -> int:
    return v if v > 0 else v + (1 << s) - 1


def _words(width: int, sizes: range, low: int, high: int) -> np.ndarray:
    """The width-bit word of each value low..high."""
    codes = {sym: code for _, code, sym in _code_table(*_fixed_codes(width, sizes))}
    return np.array([(codes[abs(v).bit_length()] << abs(v).bit_length()) | (_magnitude(v, abs(v).bit_length()) if v else 0) if abs(v).bit_length() in codes else 0 for v in range(low, high + 1)], np.uint16)


AC_TABLE, DC_TABLE, END_TABLE = _fixed_codes(8, range(1, 8)), _fixed_codes(9, range(9)), ([1] + [0] * 15, [0])
AC_WORDS, DC_WORDS = _words(8, range(1, 8), -64, 64).astype(np.uint8), _words(9, range(9), -130, 130)
_magnitudes = np.abs(VALUES) >> 1
#: AC word and refinement bit of each stored byte.
AC_OF_BYTE = AC_WORDS[np.sign(VALUES) * _magnitudes + 64]
LOW_BIT = (np.abs(VALUES) & 1).astype(np.uint8)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _stuffed(raw: bytes) -> bytes:
    return raw.replace(b"\xff", b"\xff\x00")


def _bits_out(bits: np.ndarray) -> bytes:
    """Bits padded with ones to whole bytes, stuffed."""
    gap = -len(bits) % 8
    return _stuffed(np.packbits(np.concatenate([bits, np.ones(gap, np.uint8)]) if gap else bits).tobytes())


def _table_segment(kind: int, ident: int, table: tuple[list[int], list[int]]) -> bytes:
    return _segment(0xC4, bytes([(kind << 4) | ident, *table[0], *table[1]]))


def _scan_head(comps: list[int], ss: int, se: int, ah: int, al: int) -> bytes:
    return _segment(0xDA, bytes([len(comps), *(x for c in comps for x in (c, 0)), ss, se, (ah << 4) | al]))


_HEAD = (
    b"\xff\xd8"
    + _segment(0xDB, bytes([0] + [1] * 64))
    + b"%s"
    + _table_segment(0, 0, DC_TABLE)
    + _table_segment(1, 0, AC_TABLE)
)
_LATE = _table_segment(1, 0, END_TABLE)


def _grid(blocks: int) -> tuple[int, int]:
    units = max(1, -(-blocks // 6))
    wide = math.isqrt(units - 1) + 1
    return wide, -(-units // wide)


@lru_cache(512)
def _unit_order(wide: int, tall: int) -> np.ndarray:
    """Block numbers (luma, then both chroma, each in rows) in the order of an interleaved scan."""
    n = wide * tall
    unit = np.arange(n)
    y, x = unit // wide, unit % wide
    first = 4 * wide * y + 2 * x
    return np.column_stack([first, first + 1, first + 2 * wide, first + 2 * wide + 1, 4 * n + unit, 5 * n + unit]).reshape(-1)


def encode_payload(payload: bytes) -> bytes:
    """A progressive JPEG that holds payload (whole blocks of 64 bytes) exactly."""
    blocks = len(payload) // 64
    if blocks * 64 != len(payload) or blocks == 0:
        raise ValueError("a positive multiple of 64 bytes is needed")
    wide, tall = _grid(blocks)
    n = wide * tall
    cells = np.full((6 * n, 64), 128, np.uint8)
    cells[:blocks] = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    frame = _segment(0xC2, struct.pack(">BHHB", 8, 16 * tall, 16 * wide, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
    out = [_HEAD % frame]
    order = _unit_order(wide, tall)
    dc = VALUES[cells[:, 0]].astype(np.int32)
    top = dc >> 1
    diff = np.empty(6 * n, np.int32)
    for a, b, step in ((0, 4, 4), (4, 5, 1), (5, 6, 1)):
        own = order.reshape(n, 6)[:, a:b].reshape(-1)
        diff.reshape(n, 6)[:, a:b] = np.diff(top[own], prepend=0).reshape(n, step)
    words = DC_WORDS[diff + 130]
    bits = ((words[:, None] >> np.arange(8, -1, -1, dtype=np.uint16)) & 1).astype(np.uint8).reshape(-1)
    out += [_scan_head([1, 2, 3], 0, 0, 0, 1), _bits_out(bits)]
    spans = ((1, 0, 4 * n), (2, 4 * n, 5 * n), (3, 5 * n, 6 * n))
    first = AC_OF_BYTE[cells]
    for (comp, a, b), bands in zip(spans, (((1, 5), (6, 63)), ((1, 63),), ((1, 63),)), strict=True):
        for ss, se in bands:
            out += [_scan_head([comp], ss, se, 0, 1), _stuffed(np.ascontiguousarray(first[a:b, ss : se + 1]).tobytes())]
    out += [_LATE, _scan_head([1, 2, 3], 0, 0, 1, 0), _bits_out((dc[order] & 1).astype(np.uint8))]
    low = LOW_BIT[cells]
    low[:, 0] = 0  # the code of an end of band stands before a block's corrections
    late = np.packbits(low, axis=1)
    for comp, a, b in spans:
        out += [_scan_head([comp], 1, 63, 1, 0), _stuffed(late[a:b].tobytes())]
    return b"".join([*out, b"\xff\xd9"])


@dataclass
class Component:
    ident: int
    h: int
    v: int
    quant: int
    wide: int = 0  # blocks of the whole units
    tall: int = 0
    own_wide: int = 0  # blocks of the component itself
    own_tall: int = 0
    coefs: np.ndarray = field(default_factory=lambda: np.zeros((0, 64), np.int32))


@dataclass
class Image:
    width: int
    height: int
    comps: list[Component]
    quants: dict[int, np.ndarray]


class _Bits:
    """A bit at a time from unstuffed bytes; ones after the end."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.held, self.n = raw, 0, 0, 0

    def take(self, n: int) -> int:
        while self.n < n:
            self.held = (self.held << 8) | (self.raw[self.at] if self.at < len(self.raw) else 0xFF)
            self.at, self.n = self.at + 1, self.n + 8
        self.n -= n
        out = (self.held >> self.n) & ((1 << n) - 1)
        self.held &= (1 << self.n) - 1
        return out

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = (code << 1) | self.take(1)
            if (length, code) in codes:
                return codes[length, code]
        raise ValueError("no such code")

    def value(self, s: int) -> int:
        v = self.take(s) if s else 0
        return v if s == 0 or v >> (s - 1) else v - (1 << s) + 1


def _first_ac(bits: _Bits, codes: dict, cells: np.ndarray, blocks: np.ndarray, ss: int, se: int, al: int) -> None:
    run = 0
    for b in blocks.tolist():
        if run:
            run -= 1
            continue
        k = ss
        while k <= se:
            r, s = divmod(bits.symbol(codes), 16)
            if s:
                k += r
                cells[b, k] = bits.value(s) * (1 << al)
                k += 1
            elif r == 15:
                k += 16
            else:
                run = (1 << r) + bits.take(r) - 1
                break


def _refine_ac(bits: _Bits, codes: dict, cells: np.ndarray, blocks: np.ndarray, ss: int, se: int, al: int) -> None:
    one, run = 1 << al, 0

    def correct(b: int, k: int) -> None:
        if bits.take(1) and not abs(int(cells[b, k])) & one:
            cells[b, k] += one if cells[b, k] > 0 else -one

    for b in blocks.tolist():
        k = ss
        while not run and k <= se:
            r, s = divmod(bits.symbol(codes), 16)
            new = 0
            if s:
                new = one if bits.take(1) else -one
            elif r < 15:
                run = (1 << r) + bits.take(r)
                break
            while k <= se:
                if cells[b, k]:
                    correct(b, k)
                elif r == 0:
                    break
                else:
                    r -= 1
                k += 1
            if new and k <= se:
                cells[b, k] = new
            k += 1
        if run:
            for j in range(k, se + 1):
                if cells[b, j]:
                    correct(b, j)
            run -= 1


def _fixed_width(table: list[tuple[int, int, int]], runs: bool) -> int:
    """The width of all words if length + size is the same for all symbols, else 0."""
    widths = {length + (sym & 15) for length, _, sym in table}
    if len(widths) > 1:
        return 0
    plain = all(sym < 16 and (sym or not runs) for _, _, sym in table)
    return widths.pop() if widths and plain else 0


_luts: dict[tuple, np.ndarray] = {}


def _value_lut(table: list[tuple[int, int, int]], width: int) -> np.ndarray:
    """The value of every word of a fixed width; -32768 for none."""
    key = (width, *table)
    if key not in _luts:
        lut = np.full(1 << width, -32768, np.int32)
        for length, code, s in table:
            low = np.arange(1 << s)
            lut[(code << s) + low] = np.where(low >> max(s - 1, 0) > 0, low, low - (1 << s) + 1) if s else 0
        if len(_luts) > 64:
            _luts.clear()
        _luts[key] = lut
    return _luts[key]


def _fixed_words(raw: bytes, width: int, n: int) -> np.ndarray:
    if width == 8:
        return np.frombuffer(raw, np.uint8, n)
    bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * width).reshape(n, width)
    return bits @ (1 << np.arange(width - 1, -1, -1))


def decode(raw: bytes) -> Image:
    """Gather the coefficients of all scans."""
    if raw[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, image, restart = 2, None, 0
    quants: dict[int, np.ndarray] = {}
    tables: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    while at < len(raw):
        marker, size = raw[at + 1], 0
        if marker == 0xD9:
            break
        (size,) = struct.unpack_from(">H", raw, at + 2)
        body = raw[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide, ident = body[0] >> 4, body[0] & 15
                quants[ident] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, 1).astype(np.int32)
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                counts = list(body[1:17])
                n = sum(counts)
                tables[body[0] >> 4, body[0] & 15] = _parsed_table(bytes(counts), body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            (restart,) = struct.unpack(">H", body)
        elif marker == 0xC2:
            _, tall, wide, n = struct.unpack_from(">BHHB", body)
            comps = [Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            hm, vm = max(c.h for c in comps), max(c.v for c in comps)
            across, down = -(-wide // (8 * hm)), -(-tall // (8 * vm))
            for c in comps:
                c.wide, c.tall = across * c.h, down * c.v
                c.own_wide, c.own_tall = -(-(-(-wide * c.h // hm)) // 8), -(-(-(-tall * c.v // vm)) // 8)
                c.coefs = np.zeros((c.wide * c.tall, 64), np.int32)
            image = Image(wide, tall, comps, quants)
        elif marker in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC)):
            raise ValueError("not a progressive Huffman file")
        elif marker == 0xDA:
            end = at
            while True:  # to the next marker that is neither stuffing nor a restart
                end = raw.index(b"\xff", end)
                if raw[end + 1] == 0 or 0xD0 <= raw[end + 1] <= 0xD7:
                    end += 2
                else:
                    break
            _scan(image, body, raw[at:end], tables, restart)
            at = end
    if image is None:
        raise ValueError("no frame")
    return image


def _split_restarts(data: bytes) -> list[bytes]:
    out, at, begin = [], 0, 0
    while (at := data.find(b"\xff", at)) >= 0:
        if 0xD0 <= data[at + 1] <= 0xD7:
            out.append(data[begin:at])
            begin = at + 2
        at += 2
    return [x.replace(b"\xff\x00", b"\xff") for x in [*out, data[begin:]]]


@lru_cache(512)
def _unit_grids(shape: tuple) -> list[np.ndarray]:
    """For each component of a scan, the blocks of each unit."""
    if len(shape) == 1:
        _, _, wide, _, own_wide, own_tall = shape[0]
        return [(np.arange(own_tall)[:, None] * wide + np.arange(own_wide)).reshape(-1, 1)]
    h, v, wide, tall = shape[0][:4]
    across = wide // h
    y, x = np.divmod(np.arange(across * (tall // v)), across)
    return [np.stack([(y * v + dy) * w + x * h + dx for dy in range(v) for dx in range(h)], 1) for h, v, w, *_ in shape]


def _scan(image: Image, head: bytes, data: bytes, tables: dict, restart: int) -> None:
    n = head[0]
    comps = [next(c for c in image.comps if c.ident == head[1 + 2 * i]) for i in range(n)]
    ids = [head[2 + 2 * i] for i in range(n)]
    ss, se, ah, al = head[1 + 2 * n], head[2 + 2 * n], head[3 + 2 * n] >> 4, head[3 + 2 * n] & 15
    shape = tuple((c.h, c.v, c.wide, c.tall, c.own_wide, c.own_tall) for c in comps)
    units = list(enumerate(_unit_grids(shape)))
    total = len(units[0][1])
    pieces = _split_restarts(data) if restart else [data.replace(b"\xff\x00", b"\xff")]
    step = restart or total
    for p, a in enumerate(range(0, total, step)):
        part = [(i, g[a : a + step]) for i, g in units]
        if ss == 0:
            _dc(comps, ids, part, pieces[p], tables, ah, al)
        else:
            blocks = part[0][1].reshape(-1)
            _ac(comps[0], tables[1, ids[0] & 15], blocks, pieces[p], ss, se, ah, al)


def _dc(comps: list[Component], ids: list[int], part: list, raw: bytes, tables: dict, ah: int, al: int) -> None:
    count = sum(g.shape[1] for _, g in part)
    n = len(part[0][1]) * count
    if ah:
        bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=n).reshape(-1, count)
        at = 0
        for i, g in part:
            comps[i].coefs[g, 0] |= bits[:, at : at + g.shape[1]].astype(np.int32) << al
            at += g.shape[1]
        return
    used = [tables[0, t >> 4] for t in ids]
    width = _fixed_width(used[0], False) if all(t == used[0] for t in used) else 0
    if width:
        diffs = _value_lut(used[0], width)[_fixed_words(raw, width, n)].reshape(-1, count)
    else:
        bits = _Bits(raw)
        codes = [{(length, code): sym for length, code, sym in t} for t in used]
        diffs = np.array([[bits.value(bits.symbol(codes[i])) for i, g in part for _ in range(g.shape[1])] for _ in range(len(part[0][1]))]).reshape(-1, count)
    at = 0
    for i, g in part:
        comps[i].coefs[g.reshape(-1), 0] = np.cumsum(diffs[:, at : at + g.shape[1]].reshape(-1)) << al
        at += g.shape[1]


def _ac(c: Component, table: list, blocks: np.ndarray, raw: bytes, ss: int, se: int, ah: int, al: int) -> None:
    band, n = se - ss + 1, len(blocks)
    rows = slice(None) if n == len(c.coefs) else blocks  # all blocks stand in order
    if not ah:
        width = _fixed_width(table, True)
        if width and len(raw) == -(-n * band * width // 8):
            values = _value_lut(table, width)[_fixed_words(raw, width, n * band)].reshape(n, band)
            if values.min() > -32768:
                c.coefs[rows, ss : se + 1] = values * (1 << al)
                return
    elif table == [(1, 0, 0)]:
        old = c.coefs[rows, ss : se + 1]
        if len(raw) == -(-n * (band + 1) // 8) and (old != 0).all():
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * (band + 1)).reshape(n, band + 1)
            c.coefs[rows, ss : se + 1] = old + np.where(old > 0, 1, -1) * (bits[:, 1:].astype(np.int32) << al)
            return
    codes = {(length, code): sym for length, code, sym in table}
    (_refine_ac if ah else _first_ac)(_Bits(raw), codes, c.coefs, blocks, ss, se, al)


def stored_payload(image: Image, size: int) -> bytes:
    """The first size bytes that encode_payload put into the coefficients."""
    cells = np.concatenate([c.coefs for c in image.comps])
    return _BYTES[cells + 129].tobytes()[:size]


def planes(image: Image) -> list[np.ndarray]:
    """Each component's samples at its own resolution, as float32 around 0."""
    out = []
    for c in image.comps:
        flat = np.empty((len(c.coefs), 64), np.float32)
        flat[:, ZIGZAG] = c.coefs * image.quants[c.quant]
        out.append((flat @ BASIS).reshape(c.tall, c.wide, 8, 8).transpose(0, 2, 1, 3).reshape(8 * c.tall, 8 * c.wide))
    return out


def rgb(image: Image) -> np.ndarray:
    """Full-resolution (height, width, 3) bytes; one component gives grey."""
    hm, vm = max(c.h for c in image.comps), max(c.v for c in image.comps)
    full = []
    for c, p in zip(image.comps, planes(image), strict=True):
        if (vm // c.v, hm // c.h) != (1, 1):
            p = p.repeat(vm // c.v, 0).repeat(hm // c.h, 1)
        full.append(p[: image.height, : image.width])
    if len(full) < 3:
        full = [full[0]] * 3
    else:
        y, cb, cr = full[:3]
        full = [y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb]
    return np.clip(np.rint(np.stack(full, 2) + 128), 0, 255).astype(np.uint8)
