"""Texts that hold an added token are encoded as the library does by default."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from siftline.llm import packing, textnum, token_files, tokens, work

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
TEXTS = ["a <|endoftext|> b", "<|startoftext|>x", "plain", None, "", "<|endof", "text|>", "<|EndOfText|> a", "北<|endoftext|><|endoftext|>", "<| endoftext |>", "é <|endoftext|>'s"]


@pytest.mark.parametrize("name", NAMES)
def test_encoder(name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    ids, off = tokens.encoder(path).encode(*textnum.column_bytes(pa.array(TEXTS, pa.string())))
    for s, a, b in zip(TEXTS, off[:-1], off[1:], strict=True):
        assert ids[a:b].tolist() == whole.encode(s or "", add_special_tokens=False).ids, repr(s)


def test_files_and_packing(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = []
    for name in NAMES:
        whole = Tokenizer.from_file(public_tokenizers.path(name))
        want.append({i: [*whole.encode(s or "", add_special_tokens=False).ids, 2] for i, s in enumerate(TEXTS)})
    got = token_files.read_groups(token_files.write_tokens(docs, public_tokenizers.path(NAMES[0]), work.folder(spark, "t"))).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in got} == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want[0].items()}
    packed = packing.pack_documents(docs, public_tokenizers.path(NAMES[1])).collect()
    assert {r.doc_id: r.doc_tokens for r in packed} == {i: len(x) for i, x in want[1].items()}
