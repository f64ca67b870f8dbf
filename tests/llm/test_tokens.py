"""Token files and packing against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siftline.llm import packing, textnum, token_files, tokens, work

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
HARD = ["don't it's 'tis 't''s x'S we're we'll I'd they've o'rex ''s", "  a  b\n\n c \t d ", "", "\n", " ", "é'sa ünï  über  x   a", "İstanbul 北京 x", "12 345 a1b2 ²½ 'll", "a\x1cb \x85 z\x0b\x0c q", "<|endoftext|> <|startoftext|>", "x're", "x'r", "x'", "'", "' s", " 's ", "aa 'sb", "a b", None]


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    whole = Tokenizer.from_file(public_tokenizers.path(request.param))
    whole.encode_special_tokens = True
    return tokens.Encoder(public_tokenizers.path(request.param)), whole


def rows(encoder, texts):
    ids, off = encoder.encode(*textnum.column_bytes(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)]


def test_hard_cases(both):
    fast, whole = both
    for s, got in zip(HARD, rows(fast, HARD), strict=True):
        assert got == whole.encode(s or "", add_special_tokens=False).ids, repr(s)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("aAzZ09 '\n\t.,%éßÑ stmdrevl \u0085北²_-")), max_size=30), min_size=1, max_size=4))
def test_any_text(both, texts):
    fast, whole = both
    assert rows(fast, texts) == [whole.encode(s, add_special_tokens=False).ids for s in texts]


@pytest.fixture(scope="module")
def docs(spark):
    data = [(5, "hello world"), (1, None), (2, ""), (9, "again and again " * 3000), (2, "twice"), (None, "no id"), (7, "北京 ok")]
    return spark.createDataFrame([(i, s, "x", 1) for i, s in data], "doc_id long, text string, path string, n_tokens int"), data


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, docs, encoding):
    df, data = docs
    path = work.folder(spark, "t")
    manifest = token_files.write_tokens(df, public_tokenizers.path(NAMES[0]), path, encoding=encoding, group_tokens=1000)
    whole = Tokenizer.from_file(public_tokenizers.path(NAMES[0]))
    want = {}
    for i, s in data:
        ids = np.array([*whole.encode(s or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    got = token_files.read_groups(manifest).collect()
    mine = {}
    for r in got:
        mine.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ordered = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda i: -1 if i is None else i)
    assert token_files.read_tokens(spark, path, ["n_tokens"]).count() == len(data)


def test_pages_are_indexed(spark, docs):
    import pyarrow.parquet as pq

    manifest = token_files.write_tokens(docs[0], public_tokenizers.path(NAMES[0]), work.folder(spark, "t"), encoding="delta", group_tokens=500)
    name = manifest.first().path
    fs, local = work.opened(name)
    with fs.open_input_file(local) as f:
        column = pq.ParquetFile(f).metadata.row_group(0).column(2)
        assert "DELTA_BINARY_PACKED" in column.encodings and column.has_offset_index


def test_empty_table(spark, docs):
    empty = docs[0].limit(0)
    manifest = token_files.write_tokens(empty, public_tokenizers.path(NAMES[0]), work.folder(spark, "t"))
    assert token_files.read_groups(manifest).count() == 0
    assert packing.pack_documents(empty, public_tokenizers.path(NAMES[1])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_first_fit_decreasing(sizes):
    sizes = sorted(sizes, reverse=True)
    seq, off = packing.first_fit_decreasing(np.array(sizes, np.int64), 64)
    used = []
    for size, s, o in zip(sizes, seq.tolist(), off.tolist(), strict=True):
        first = next((i for i, u in enumerate(used) if u + size <= 64), len(used))
        if first == len(used):
            used.append(0)
        assert (s, o) == (first, used[first])
        used[first] += size


def test_packing(spark, docs):
    df, data = docs
    whole = Tokenizer.from_file(public_tokenizers.path(NAMES[1]))
    want = sorted([*whole.encode(s or "", add_special_tokens=False).ids, 2] for _, s in data)
    got = packing.pack_documents(df, public_tokenizers.path(NAMES[1]), with_ids=True).collect()
    for r in got:
        assert r.length == len(r.ids) <= 4096 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096
    joined = []
    for parts in by_doc.values():
        for r in sorted(parts, key=lambda r: r.start):
            if r.start == 0:
                joined.append([])
            joined[-1] += r.ids
    assert sorted(joined) == want


def test_little_padding(spark):
    from conftest import SF

    got = packing.pack_documents(spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet"), public_tokenizers.path(NAMES[1])).collect()
    total, sequences = sum(r.length for r in got), len({r.sequence_id for r in got})
    assert sequences <= -(-total // 4096) + 1
