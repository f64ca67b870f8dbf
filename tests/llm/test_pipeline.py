"""The stages one after another, each on all that its predecessor kept."""

import re

from siftline.llm import quality, queries


def test_stages(spark):
    import corpus_pipeline as cp
    from conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "ngram_jaccard_join", "mixing", "packing"]
    model = quality.train(docs, quality.rate(spark.read.parquet(f"{SF}/labels.parquet")))
    keep = {r.doc_id for r in quality.classify(docs, model).filter("keep").collect()}
    one = cp.classify(spark, docs, SF)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == keep
    two = cp.deduplicate(spark, one, SF)
    left = {r.doc_id: r.text for r in two.collect()}
    assert two.columns == docs.columns and set(left) <= keep

    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))

    sets = {i: grams(t) for i, t in left.items()}
    full = {r.doc_id: grams(r.text) for r in one.collect()}
    for a in sets:
        for b in sets:
            assert a >= b or len(sets[a] & sets[b]) < 0.8 * len(sets[a] | sets[b])
    for i, s in full.items():  # what went is near to something, though perhaps over others
        assert i in sets or any(j != i and len(s & t) >= 0.8 * len(s | t) - 1e-9 for j, t in full.items())
    three = cp.mix(spark, two, SF)
    assert three.columns == docs.columns and {r.doc_id for r in three.collect()} <= set(left)
    four = cp.pack(spark, three, SF).collect()
    assert sum(r.doc_tokens for r in four if r.start == 0) == sum(r.length for r in four)
    assert cp.run(spark, SF).count() == len(four)


def tables(spark, path, rows):
    """documents with columns of clashing names, and labels of no document."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, keep string, size int, sequence_id long"
    spark.createDataFrame([(i, t, "en", s, len(t or ""), "k", 1, 2) for i, t, s in rows], schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(10**9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_cases(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows and null ids, through every stage."""
    import corpus_pipeline as cp

    plain = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(k, plain(k), "ab"[k % 2]) for k in range(20)] + [(3, plain(3), "b")] * 5 + [(3, plain(100), "b"), (50, None, "a"), (51, "", "a"), (52, " ", None), (53, "long " * 60_000, None), (None, plain(101), "a"), (None, plain(4), "a"), (60, plain(5), "a")]
    sf = tables(spark, tmp_path, rows)
    out = cp.run(spark, sf)
    pieces = out.collect()
    # one of each group of copies, id by id: those without words are in no mix
    kept = {r.doc_id for r in pieces}
    assert kept == {*range(20), 53, None} and 60 not in kept
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        ends = 0
        for at, n in sorted(places):
            assert at == ends
            ends += n
        assert ends <= 4096
    long = [r for r in pieces if r.doc_id == 53]
    assert sum(r.length for r in long) % long[0].doc_tokens == 0
    again = cp.run(spark, sf).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, again)) == sorted(map(key, pieces))


def test_empty_tables(spark, tmp_path):
    import corpus_pipeline as cp

    tables(spark, tmp_path / "x", [(1, "a", "s")])
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tmp_path}/x/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/y/{name}.parquet")
    assert cp.run(spark, f"{tmp_path}/y").count() == 0


def test_registered():
    import __spark_entry__ as e

    assert set(queries.queries()) | {"pipeline"} <= set(e.queries())
