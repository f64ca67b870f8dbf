"""Mixing against a plain loop."""

import re

import pytest
from pyspark.sql import functions as F

from siftline.llm import mixing

ROWS = [(i, " ".join(["w"] * (1 + i * 7 % 40)), ["a", "b", "B", None, "é"][i % 5 if i % 3 else 0]) for i in range(200)] + [(900, None, "a"), (901, "", "zero"), (5, "w w w", "a"), (5, "w w w", "a"), (None, "x y", "b")]


def plain_targets(sizes, budget, cap):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), budget * sum(sizes.values()), {s for s in names if sizes[s]}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        for s in over or open_:
            target[s] = cap * sizes[s] if over else left * weight[s] / total
        left -= sum(target[s] for s in over)
        open_ = open_ - over if over else set()
    return target


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1.0, 2, 3, "x") for r in ROWS], "doc_id long, text string, source string, position double, size int, turn int, at string")


def test_targets_and_words(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    sizes = {}
    for _, t, s in ROWS:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(sizes, 1.5, 2)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, words in taken.items():
        assert abs(words - want[s]) <= 1
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken, r.position or -1)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_positions_follow_demand(spark, docs):
    """The words called for by a time are the source's cumulative demand."""
    turns = mixing.passes(mixing.mix(docs)).collect()
    for s in {r.source for r in turns}:
        mine = sorted((r for r in turns if r.source == s), key=lambda r: r.before + r.turn * r.source_size)
        assert [r.position for r in mine] == sorted(r.position for r in mine)
        for r in mine:
            a, t = r.ramp, r.position
            assert r.target * (a * t + (1 - a) * t * t) == pytest.approx(r.before + r.turn * r.source_size, abs=1e-3 * r.target + 1e-6)


def test_documents(spark, docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    count = {}
    for r in out.collect():
        count[(r.doc_id, r.text)] = count.get((r.doc_id, r.text), 0) + 1
    want = {}
    for r in mixing.mix(docs, whole=True).collect():
        want[(r.doc_id, r.size)] = want.get((r.doc_id, r.size), 0) + r.repeats
    got = {}
    for (i, t), n in count.items():
        got[(i, len((t or "").split()))] = got.get((i, len((t or "").split())), 0) + n
    assert got == {k: v for k, v in want.items() if v}


def test_query_is_in_order(spark, docs, tmp_path):
    """Partitions hold ranges of positions, sorted, what is not taken last; all rows are there."""
    mixing.in_order(mixing.mix(docs)).write.parquet(f"{tmp_path}/out")
    rows = [r for p in sorted((tmp_path / "out").glob("part-*")) for r in spark.read.parquet(str(p)).collect()]
    places = [(r.position is None, r.position or 0.0) for r in rows]
    assert places == sorted(places) and len(rows) == len(ROWS)


def test_documents_are_in_even_ranges(spark):
    rows = [(i, "w " * 50, "abc"[i % 3] if i % 7 else "d") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = [r.n for r in mixing.mixed_documents(docs).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < 1.2 * min(sizes)


def test_hot_rows(spark):
    """Copies of one row are counted before they meet, and stand one after the other."""
    rows = [(1, "a b c", "s")] * 500 + [(k, "d e", "s") for k in range(2, 300)] + [(k, "f", "t") for k in range(300, 400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows) and sorted(r.before for r in got if r.doc_id == 1) == sorted({r.before for r in got if r.doc_id == 1})
    for s in "st":
        target = {r.target for r in got if r.source == s}
        assert abs(sum(r.taken for r in got if r.source == s) - target.pop()) <= 1 and not target


@pytest.mark.parametrize("sizes", [[10, 0], [100, 1], [0, 0], [5], [1, 1, 1, 1000], [1000, 1, 1, 1], list(range(1, 40))])
def test_source_targets(spark, sizes):
    names = [f"s{k:03d}" for k in range(len(sizes))]
    names[-1] = None
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    want = plain_targets(dict(zip(names, sizes)), 1.5, 2)
    got = mixing.source_targets(df, (3.0, 1.0, 2.0), 1.5, 2).collect()
    assert {r.source: r.target for r in got} == {s: pytest.approx(t) for s, t in want.items()}


def test_edges(spark, docs):
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs.limit(0)).count() == 0
