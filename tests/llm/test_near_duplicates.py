"""The Jaccard join against all pairs, and its parts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from siftline.llm import near_duplicates as nd
from siftline.llm import queries, textnum


def brute(rows, threshold=0.8):
    import re

    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    head = {}
    for a in range(n):
        if rows[a][0] is not None:
            head[find(a)] = min(head.get(find(a), rows[a][0]), rows[a][0])
    return ordered((rows[a][0], head.get(find(a)), links[a]) for a in range(n))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def linked(spark, rows):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int")
    return ordered((r.doc_id, r.class_id, r.n_links) for r in nd.near_duplicates(df).collect())


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for _ in range(40):
        base = [word() for _ in range(rng.choice([3, 6, 30, 120]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    base = [word() for _ in range(100)]
    for _ in range(60):
        copy = list(base)
        copy[rng.randrange(100)] = word()
        texts.append(" ".join(copy))
    texts += [None, "", " ", "One two", "one TWO", "same text here now ok"] + ["same text here now ok"] * 5
    return list(enumerate(texts)) + [(3, texts[3])]


def test_against_all_pairs(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(nd, "BLOCK", 16)  # the group of sixty takes several blocks
    assert linked(spark, rows) == brute(rows)


def test_compared_by_bands(spark, monkeypatch):
    """Components that chain many bands are compared band by band, with the same links."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(60)]
    rows = []
    for k in range(90):  # a chain: neighbours are alike, ends are not
        base[(7 * k) % 60] = word()
        rows.append((k, " ".join(base)))
    monkeypatch.setattr(nd, "BLOCK", 4)
    told = []
    blocks = nd._blocks
    monkeypatch.setattr(nd, "_blocks", lambda *a: told.append(blocks(*a)) or told[-1])
    assert linked(spark, rows) == brute(rows)
    assert told[0].filter("band >= 0").count() and told[0].filter("parts > 1").count()


def test_repeated_and_null_ids(spark):
    rng = random.Random(5)
    a, b = ([rng.choice("abcdefgh") + rng.choice("ijklmnop") * 3 + str(k) for k in range(60)] for _ in range(2))
    near = lambda x: " ".join([*x[:-1], "other"])
    text = " ".join
    # one id on two texts; an id on a text and on nothing; repeated rows; null ids alone and in groups
    rows = [(5, text(a)), (5, text(b)), (6, near(a)), (7, near(b)), (8, None), (8, text(a[::-1])), (9, "x y"), (9, "x y"), (None, near(b)), (None, "lone text"), (None, "lone text"), (None, None)]
    assert linked(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((str(r.doc_id), r.text or "") for r in nd.keep_first(df).collect())
    assert kept == sorted([("5", text(a)), ("5", text(b)), ("8", ""), ("8", text(a[::-1])), ("9", "x y"), ("None", "lone text"), ("None", "")])


def test_hot_row(spark):
    rows = [(1, "the same row again and again")] * 300 + [(k, f"text number {k} stands alone") for k in range(2, 60)]
    assert linked(spark, rows) == brute(rows)
    assert nd.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).count() == 59


def test_keep_first(spark):
    rows = corpus(4)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, __near_x int")
    kept = nd.keep_first(df)
    assert kept.columns == df.columns
    # one of each group, and each text without words
    words = [r for r in rows if (r[1] or "").strip()]
    bare = [r[0] for r in rows if not (r[1] or "").strip()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*{h for _, h, _ in brute(words)}, *bare])
    assert nd.keep_first(df.limit(0)).count() == 0


def test_query_equals_sql(spark, duck):
    from conftest import SF, same

    same(queries.op1_ngram_jaccard_join(spark, SF), duck, queries.OP1)


def test_fewest_matches_is_the_posterior():
    few = nd.fewest_matches(0.8, 1e-6)
    s = (np.arange(100_000) + 0.5) / 100_000
    for n in (16, 64, 160):
        m = few[n]
        for k, kept in ((m, True), (m - 1, False)):
            density = s**k * (1 - s) ** (n - k)
            assert (density[s >= 0.8].sum() / density.sum() >= 1e-6) == kept


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for share in (0.5, 0.8, 0.95):
        a, b = pool[:1000], np.concatenate([pool[: int(1000 * share)], pool[1500 : 2500 - int(1000 * share)]])
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sig = nd.minhashes(np.concatenate([a, b]), np.array([0, 1000, 1000 + len(b)]))
        assert abs((sig[0] == sig[1]).mean() - truth) < 0.12


def test_dense_and_sparse_counts_agree():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    i, j = np.triu_indices(30, 1)
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)]
    assert nd.shared_counts(sets, sets, i, j).tolist() == want
    assert nd.shared_counts(sets, sets, i[:50], j[:50]).tolist() == want[:50]


def test_components(spark):
    from siftline.llm import work

    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 200), (200, 300), (300, 100), (7, 7)]
    got = {r.node: r.comp for r in nd.connected(spark.createDataFrame(edges, "a long, b long"), work.folder(spark, "cc")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 200: 100, 300: 100}
    assert nd.connected(spark.createDataFrame([], "a long, b long"), work.folder(spark, "cc")).count() == 0
    with pytest.raises(RuntimeError):
        nd.connected(spark.createDataFrame(edges, "a long, b long"), work.folder(spark, "cc"), rounds=2)


@pytest.mark.parametrize("texts", [["a b", "", None, "  x\ty\n z", "é a", "a" * 50], ["one"], [""]])
def test_words(texts):
    import re

    data, off = textnum.column_bytes(pa.array(texts, pa.string()))
    starts, ends, row = textnum.word_spans(data, off)
    got = [[] for _ in texts]
    for s, e, r in zip(starts, ends, row, strict=True):
        got[r].append(data[s:e].tobytes())
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
