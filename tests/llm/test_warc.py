"""WARC round trips: any split gives every record once."""

import gzip
import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftline.llm import queries, warc, work

ROWS = [(1, "http://a", "<p>x</p>"), (2, "http://b\r\nX: y%", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u", "é" * 300_000), (6, "u", "WARC/1.1\r\n\r\nnested"), (None, "u", "<p>x</p>"), (7, "u", "alone"), (7, "u", "alone")]


@pytest.mark.parametrize("split", [64, 1024, 1 << 20])
def test_round_trip(spark, split):
    pages = spark.createDataFrame([(*r, b"?") for r in ROWS], "page_id long, url string, html string, payload binary")
    manifest = warc.write_warc(warc.mark_revisits(pages).repartition(2), work.folder(spark, "warc"))
    got = warc.read_warc(manifest, split).collect()
    assert sorted((r.page_id or 0, r.url or "") for r in got) == sorted((i or 0, u or "") for i, u, _ in ROWS)
    html = {i: (h or "").encode() for i, _, h in ROWS}
    last = {1: 2, None: 2, 3: 4}
    for r in got:
        assert r.payload_bytes == len(html[r.page_id])
        assert r.refers_to == last.get(r.page_id) and r.record_type == ("revisit" if r.page_id in last else "response")
        assert r.payload_digest == warc.digest32(html[r.page_id])
        if r.record_type == "response":
            assert r.payload == html[r.page_id]


def test_least_size(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    assert sorted((r.page_id, r.refers_to) for r in warc.mark_revisits(pages, 3).collect()) == [(1, None), (2, None), (3, 4), (4, None)]


def test_members_are_plain_gzip():
    raw = warc.record(1, "u", b"payload", None, False)
    assert gzip.decompress(warc.member(raw)) == raw
    assert warc.parse(raw)["block"] == b"payload" and warc.parse(raw[:40]) is None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=200), min_size=1, max_size=12), st.integers(1, 300))
def test_every_record_once(payloads, step):
    raw = b"".join(warc.member(warc.record(i, None, p, None, False)) for i, p in enumerate(payloads))
    got = [(o, r["x-page-id"], r["block"]) for a in range(0, len(raw), step) for o, r in warc.scan(pa.BufferReader(raw), len(raw), a, a + step)]
    assert [int(i) for _, i, _ in got] == list(range(len(payloads))) and [b for _, _, b in got] == payloads


def test_stray_magic_is_no_record():
    stray = warc.MAGIC + b"junk" + warc.MAGIC
    raw = stray + warc.member(warc.record(1, None, b"p", None, False)) + stray
    assert [r["block"] for _, r in warc.scan(pa.BufferReader(raw), len(raw), 0, len(raw))] == [b"p"]


def test_empty_and_query(spark, duck):
    from conftest import SF, same

    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(warc.write_warc(warc.mark_revisits(none), work.folder(spark, "warc"))).count() == 0
    same(queries.op2_warc(spark, SF), duck, queries.OP2)
    assert hashlib.sha1(b"").digest()
