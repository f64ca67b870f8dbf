"""Progressive JPEG: payload round trips, and general files against a plain transform."""

import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftline.llm import media, progressive as pj, work


class Writer:
    """A slow general encoder: any coefficients, any script, ordinary Huffman codes of 8 bits."""

    def __init__(self, comps, width, height):
        self.comps, self.out, self.bits = comps, [b"\xff\xd8", pj._segment(0xDB, bytes([0, *range(1, 65)]))], []
        self.out.append(pj._segment(0xC2, bytes([8, height >> 8, height & 255, width >> 8, width & 255, len(comps)]) + b"".join(bytes([i + 1, c["h"] << 4 | c["v"], 0]) for i, c in enumerate(comps))))
        # all 255 symbols with codes of 8 and 9 bits
        counts = [0] * 7 + [254, 2] + [0] * 7
        table = bytes([*counts, *range(256)])
        self.out += [pj._segment(0xC4, bytes([0]) + table), pj._segment(0xC4, bytes([16]) + table)]
        self.codes = {sym: (length, code) for length, code, sym in pj._code_table(counts, list(range(256)))}

    def put(self, value, n):
        self.bits += [(value >> k) & 1 for k in range(n - 1, -1, -1)]

    def sym(self, s):
        length, code = self.codes[s]
        self.put(code, length)

    def scan(self, ids, ss, se, ah, al):
        self.out += [pj._scan_head([i + 1 for i in ids], ss, se, ah, al), pj._bits_out(np.array(self.bits, np.uint8))]
        self.bits = []

    def dc(self, order, ah, al):
        last = [0] * len(self.comps)
        for i, b in order:
            v = int(self.comps[i]["coefs"][b, 0])
            if ah:
                self.put((v >> al) & 1, 1)
            else:
                d, last[i] = (v >> al) - last[i], v >> al
                s = abs(d).bit_length()
                self.sym(s)
                self.put(pj._magnitude(d, s) if s else 0, s)

    def ac_first(self, i, blocks, ss, se, al):
        run = 0

        def flush():
            nonlocal run
            while run:
                r = min(run.bit_length() - 1, 14)
                self.sym(r << 4)
                self.put(run & ((1 << r) - 1), r)
                run -= (1 << r) + (run & ((1 << r) - 1))

        for b in blocks:
            zeros, some = 0, False
            for k in range(ss, se + 1):
                c = int(self.comps[i]["coefs"][b, k])
                t = (abs(c) >> al) * (1 if c > 0 else -1)
                if t == 0:
                    zeros += 1
                    continue
                flush()
                while zeros > 15:
                    self.sym(0xF0)
                    zeros -= 16
                s = abs(t).bit_length()
                self.sym(zeros << 4 | s)
                self.put(pj._magnitude(t, s), s)
                zeros, some = 0, True
            if zeros or not some and ss <= se:
                run += 1
        flush()

    def ac_refine(self, i, blocks, ss, se, al):
        for b in blocks:
            cells = [int(x) for x in self.comps[i]["coefs"][b]]
            new = [k for k in range(ss, se + 1) if abs(cells[k]) >> al == 1]
            k, pending = ss, []
            zeros = 0
            for k in range(ss, se + 1):
                t = abs(cells[k]) >> al
                if t == 0:
                    zeros += 1
                    if zeros == 16 and any(n > k for n in new):
                        self.sym(0xF0)
                        self.bits += pending
                        pending, zeros = [], 0
                elif t == 1:
                    self.sym(zeros << 4 | 1)
                    self.put(1 if cells[k] > 0 else 0, 1)
                    self.bits += pending
                    pending, zeros = [], 0
                else:
                    pending.append(t & 1)
            if zeros or pending:
                self.sym(0)
                self.bits += pending

    def done(self):
        return b"".join([*self.out, b"\xff\xd9"])


def general(seed, samplings, width, height):
    rng = np.random.default_rng(seed)
    hm, vm = max(h for h, _ in samplings), max(v for _, v in samplings)
    across, down = -(-width // (8 * hm)), -(-height // (8 * vm))
    comps = []
    for h, v in samplings:
        n = across * h * down * v
        coefs = rng.integers(-40, 41, (n, 64)) * (rng.random((n, 64)) < 0.25)
        comps.append({"h": h, "v": v, "wide": across * h, "coefs": coefs, "own": (-(-(-(-width * h // hm)) // 8), -(-(-(-height * v // vm)) // 8))})
    w = Writer(comps, width, height)
    if len(comps) > 1:
        order = [(i, (y * c["v"] + dy) * c["wide"] + x * c["h"] + dx) for y in range(down) for x in range(across) for i, c in enumerate(comps) for dy in range(c["v"]) for dx in range(c["h"])]
    else:
        order = [(0, y * comps[0]["wide"] + x) for y in range(comps[0]["own"][1]) for x in range(comps[0]["own"][0])]
    every = list(range(len(comps)))
    grids = [[y * c["wide"] + x for y in range(c["own"][1]) for x in range(c["own"][0])] for c in comps]
    w.dc(order, 0, 1)
    w.scan(every, 0, 0, 0, 1)
    for i in every:
        for ss, se, al in ((1, 5, 2), (6, 63, 2)):
            w.ac_first(i, grids[i], ss, se, al)
            w.scan([i], ss, se, 0, al)
    w.dc(order, 1, 0)
    w.scan(every, 0, 0, 1, 0)
    for al in (1, 0):
        for i in every:
            w.ac_refine(i, grids[i], 1, 63, al)
            w.scan([i], 1, 63, al + 1, al)
    return w.done(), comps, grids


@pytest.mark.parametrize("samplings,size", [([(1, 1)], (20, 13)), ([(2, 2), (1, 1), (1, 1)], (40, 24)), ([(2, 1), (1, 1), (1, 1)], (17, 9)), ([(1, 1)] * 3, (16, 16))])
def test_general_files(samplings, size):
    raw, comps, grids = general(1, samplings, *size)
    image = pj.decode(raw)
    for c, want, grid in zip(image.comps, comps, grids, strict=True):
        # what an interleaved scan pads has a DC only
        assert (c.coefs[grid] == want["coefs"][grid]).all()
    assert pj.rgb(image).shape == (size[1], size[0], 3)


def test_inverse_transform():
    rng = np.random.default_rng(2)
    flat = rng.normal(size=64).astype(np.float32)
    cell = lambda n: 1 / math.sqrt(2) if n == 0 else 1
    want = [sum(cell(u) * cell(v) / 4 * flat[8 * u + v] * math.cos((2 * y + 1) * u * math.pi / 16) * math.cos((2 * x + 1) * v * math.pi / 16) for u in range(8) for v in range(8)) for y in range(8) for x in range(8)]
    assert np.allclose(flat @ pj.BASIS, want, atol=1e-4)
    assert pj.ZIGZAG[:6].tolist() == [0, 1, 8, 16, 9, 2] and sorted(pj.ZIGZAG) == list(range(64))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 2**32 - 1))
def test_payload_round_trip(blocks, seed):
    payload = np.random.default_rng(seed).integers(0, 256, 64 * blocks, dtype=np.uint8).tobytes()
    assert pj.stored_payload(pj.decode(pj.encode_payload(payload)), len(payload)) == payload


def test_fixed_width_and_symbols_agree(monkeypatch):
    payload = bytes(range(256)) * 7
    raw = pj.encode_payload(payload)
    fast = pj.decode(raw)
    monkeypatch.setattr(pj, "_fixed_width", lambda *a: 0)
    slow = pj.decode(raw)
    for a, b in zip(fast.comps, slow.comps, strict=True):
        assert (a.coefs == b.coefs).all()


def test_restarts():
    raw = pj.encode_payload(bytes(64))
    assert pj._split_restarts(b"a\xff\x00b\xff\xd0c\xff\xd1") == [b"a\xffb", b"c", b""]
    with pytest.raises(ValueError):
        pj.decode(raw.replace(b"\xff\xc2", b"\xff\xc0"))


def test_media_table(spark):
    import hashlib

    rows = [(1, "hello"), (2, None), (3, ""), (4, "é" * 5000), (5, "hello"), (None, "x" * 64), (1, "hello")]
    df = spark.createDataFrame([(*r, b"z") for r in rows], "doc_id long, text string, media binary")
    got = media.decode_media(media.store_media(df, work.folder(spark, "m")), tensors=True).collect()
    assert len(got) == len(rows)
    want = sorted(((i or 0), len((t or "").encode())) for i, t in rows)
    assert sorted((r.doc_id or 0, r.n_bytes) for r in got) == want
    texts = dict(rows)
    for r in got:
        body = (texts[r.doc_id] or "").encode()
        payload = body.ljust(max(64, -(-len(body) // 64) * 64), b"\0")
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        assert len(r.rgb) == r.height * r.width * 3
        assert r.feature == media.tensor_feature(np.frombuffer(r.rgb, np.uint8).reshape(r.height, r.width, 3))
    assert len({(r.media_sha256, r.feature) for r in got if texts[r.doc_id] == "hello"}) == 1
    assert media.decode_media(media.store_media(df.limit(0), work.folder(spark, "m"))).count() == 0


def test_query(spark):
    """Every document of the table: payload and stored form against the texts and the files themselves."""
    import hashlib

    from conftest import SF

    from siftline.llm import queries

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stored = {r.doc_id: bytes(r.media) for r in media.store_media(docs, work.folder(spark, "m")).collect()}
    got = queries.op4_progressive_jpeg(spark, SF).collect()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        body = (texts[r.doc_id] or "").encode()
        payload, raw = body.ljust(max(64, -(-len(body) // 64) * 64), b"\0"), stored[r.doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(body), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(raw), hashlib.sha256(raw).hexdigest()) and raw[:2] == b"\xff\xd8" and raw[-2:] == b"\xff\xd9" and b"\xff\xc2" in raw
    for r in sorted(got, key=lambda r: r.n_bytes)[:3]:
        own, mine = media.tensor_feature(plain_rgb(stored[r.doc_id])).split("|"), r.feature.split("|")
        assert own[0] == mine[0]
        for x, y in zip(own[1:], mine[1:]):
            assert all(abs(int(i) - int(j)) <= 1000 for i, j in zip(x.split(","), y.split(",")))  # a step of one sample, in thousandths


def plain_rgb(raw):
    """The image pixel by pixel: cosine sums in doubles, nearest chroma, the colour matrix."""
    image = pj.decode(raw)
    hm, vm = max(c.h for c in image.comps), max(c.v for c in image.comps)

    def sample(c, y, x):
        block = c.coefs[(y // 8) * c.wide + x // 8] * image.quants[c.quant]
        total = 0.0
        for k in range(64):
            if block[k]:
                u, v = divmod(int(pj.ZIGZAG[k]), 8)
                total += block[k] * (math.sqrt(0.5) if u == 0 else 1) * (math.sqrt(0.5) if v == 0 else 1) / 4 * math.cos((2 * (y % 8) + 1) * u * math.pi / 16) * math.cos((2 * (x % 8) + 1) * v * math.pi / 16)
        return total

    out = np.zeros((image.height, image.width, 3), np.uint8)
    for y in range(image.height):
        for x in range(image.width):
            v = [sample(c, y * c.v // vm, x * c.h // hm) for c in image.comps]
            r, g, b = (v[0] + 1.402 * v[2], v[0] - 0.344136 * v[1] - 0.714136 * v[2], v[0] + 1.772 * v[1]) if len(v) == 3 else v[:1] * 3
            out[y, x] = np.clip(np.rint(np.array([r, g, b]) + 128), 0, 255)
    return out
