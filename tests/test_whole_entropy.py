"""Entropy is that of whole documents."""

import math
from collections import Counter

import duckdb
import pytest
from conftest import SF

from siftline.plans import catalogue


def bits(s):
    return sum(n / len(s) * -math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0


def test_whole_documents(spark):
    docs = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert any(len(t) > 200 for _, t in docs)
    got = {r.doc_id: r.bits for r in catalogue.queries()["entropy"](spark, SF).collect()}
    assert got == pytest.approx({i: bits(t) for i, t in docs}, abs=1e-6)


def test_edges(spark, tmp_path):
    docs = [(1, "a" * 200 + "b" * 200), (2, ""), (3, None), (4, "é北😀" * 100), (4, "x" * 500)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.bits) for r in catalogue.queries()["entropy"](spark, str(tmp_path)).collect())
    assert got == [(1, 1.0), (2, 0.0), (3, 0.0), (4, 0.0), (4, pytest.approx(math.log2(3), abs=1e-6))]
