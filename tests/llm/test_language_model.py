"""Scores against dictionaries; weights against plain expectation-maximisation."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from siftline.llm import language_model as lm


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + ["</s>"]


ROWS = [(i, " ".join(f"w{(i * k) % 7}" for k in range(i % 23)).replace("w3", "W3"), "x") for i in range(300)] + [(1000, None, "x"), (1001, "", "x"), (1002, "unseen words", "x"), (7, "w1 w2", "x"), (7, "w1 w2", "x")]


@pytest.mark.parametrize("unit", [200, 1 << 20])
def test_scores(spark, unit):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, score string")
    got = {}
    for r in lm.score_documents(df, unit_bytes=unit).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(ROWS)
    trains = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    one, two, ctx = Counter(), Counter(), Counter()
    for i, t, _ in ROWS:
        if trains(i):
            w = words(t)
            one.update(w)
            for a, b in zip(["<s>", *w], w):
                two[a, b] += 1
                ctx[a] += 1
    n, v = sum(one.values()), len(one)
    texts = {i: t for i, t, _ in ROWS}
    assert sorted(r.n_tokens for r in got[7]) == sorted(len(words(t)) for i, t, _ in ROWS if i == 7)
    del got[7]  # three rows, two texts
    for i, rs in got.items():
        w = words(texts[i])
        for r in rs:
            assert r.held_out == (not trains(i)) and r.n_tokens == len(w) and r.train_tokens == n
            assert r.n_known == sum(one[x] > 0 for x in w)
            assert r.base_score == pytest.approx(sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w))
    # held-out counts, exactly, give nearly the weights that the binned histogram gives
    hist = Counter()
    for i, t, _ in ROWS:
        if trains(i):
            w = words(t)
            for a, b in zip(["<s>", *w], w):
                c = ctx[a] - 1
                hist[int(lm._bucket(np.array([c]))[0]), (one[b] - 1) / (n - 1), (two[a, b] - 1) / c if c else 0.0] += 1
    weights = {}
    for k in {b for b, _, _ in hist}:
        lam = np.full(3, 1 / 3)
        part = [(u, x, c) for (b, u, x), c in hist.items() if b == k]
        for _ in range(60):
            acc = np.zeros(3)
            for u, x, c in part:
                p = lam * [1 / (v + 1), u, x]
                acc += c * p / p.sum()
            lam = acc / acc.sum()
        weights[k] = lam
    worst = 0.0
    for i, rs in got.items():
        w = words(texts[i])
        total = 0.0
        for a, b in zip(["<s>", *w], w):
            lam = weights.get(int(lm._bucket(np.array([ctx[a]]))[0]))
            if lam is None:
                break
            total += math.log10(lam @ [1 / (v + 1), one[b] / n, two[a, b] / ctx[a] if ctx[a] else 0.0])
        else:
            worst = max(worst, abs(rs[0].score - total) / len(w))
    assert worst < 0.1


def test_better_than_base_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in lm.score_documents(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_probabilities_sum_to_one():
    """Over the vocabulary and one unknown word, after any context."""
    w = lm.fit_weights([(1, [5, 9], 3), (2, [4, 0], 2)], 2, 10)
    assert w.shape == (lm.BUCKETS, 3) and np.allclose(w.sum(1), 1)
    assert (w > 0).all()


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_packing_of_keys_and_counts(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
    counts = rng.integers(0, 600, len(keys))
    assert (lm._undeltas(lm._deltas(keys)) == keys).all() and (lm._counts_unpacked(lm._counts_packed(counts)) == counts).all()


@pytest.mark.parametrize("c", [[], [5], [0, 300, 7, 7, 1 << 40], list(range(70_000))])
def test_packing_of_token_counts(c):
    c = np.array(c, np.int64)
    assert (lm._from_index(lm._indexed(c)) == c).all()


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_contexts_are_the_shorter_ngrams(order):
    """Counts of contexts, taken from the n-gram before, against counting them."""
    rng = np.random.default_rng(order)
    docs = [[*rng.integers(1, 5, rng.integers(0, 12)).tolist(), 0] for _ in range(40)]
    pad = lambda d: [None] * order + d
    seen = [Counter(tuple(pad(d)[i + order - n + 1 : i + order + 1]) for d in docs for i in range(len(d))) for n in range(1, order + 1)]
    ctx = [Counter(tuple(pad(d)[i + order - n + 1 : i + order]) for d in docs for i in range(len(d))) for n in range(1, order + 1)]
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    key = lambda n, d, i: tuple(pad(d)[i + order - n + 1 : i + order + 1])
    grams = [np.array([seen[n - 1][key(n, d, i)] for d in docs for i in range(len(d))]) for n in range(1, order + 1)]
    ests, _ = lm._estimates(grams, row, len(row), False)
    for n in range(2, order + 1):
        want = [seen[n - 1][key(n, d, i)] / ctx[n - 1][key(n, d, i)[:-1]] for d in docs for i in range(len(d))]
        assert np.allclose(ests[n - 1], want)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_documents(empty).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = lm.score_documents(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in rows] == [(0, 0, 0.0, 0.0)] * 3
    long = lm.score_documents(spark.createDataFrame([(3, "once upon a time " * 50_000), (2, "once")], "doc_id long, text string"), unit_bytes=1 << 16, task_bytes=1 << 12).collect()
    assert {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens) for r in long} == {3: (200_001, 200_001, 200_003), 2: (2, 2, 200_003)}
    null = lm.score_documents(spark.createDataFrame([(None, "a"), (1, "a")], "doc_id long, text string")).collect()
    assert sorted(r.n_tokens for r in null) == [2, 2]
