"""Ordinal regression: gradients, held-out accuracy, edge cases."""

import numpy as np
import pyarrow as pa
import pytest

from siftline.llm import quality, textnum


def test_recovers_order():
    rng = np.random.default_rng(0)
    good, bad = [f"g{i}" for i in range(5)], [f"b{i}" for i in range(5)]
    texts, grades = [], []
    for _ in range(300):
        g = int(rng.integers(0, 3))
        texts.append(" ".join([*rng.choice(good, g * 2), *rng.choice(bad, (2 - g) * 2), *(f"w{rng.integers(0, 500)}" for _ in range(10))]))
        grades.append(g)
    index, row = quality.distinct(*quality.features(*textnum.column_bytes(pa.array(texts))))
    model = quality.fit(index, row, np.array(grades), 3)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.at_least(model.score(index, row, len(texts)))
    assert np.corrcoef(tails.sum(1), grades)[0, 1] > 0.9
    assert (tails[:, 0] >= tails[:, 1]).all()


def test_gradient_lowers_loss():
    rng = np.random.default_rng(1)
    index, row, grade = rng.integers(0, 60, 400), np.repeat(np.arange(40), 10), rng.integers(0, 3, 40)

    def loss(m):
        t = m.at_least(m.score(index, row, 40))
        p = np.column_stack([1 - t[:, 0], t[:, 0] - t[:, 1], t[:, 1]])
        return -np.log(np.maximum(p[np.arange(40), grade], 1e-12)).mean()

    assert loss(quality.fit(index, row, grade, 3, steps=200)) < loss(quality.fit(index, row, grade, 3, steps=1))


def graded_texts(rng, n=120):
    words = [f"w{k}" for k in range(60)]
    texts, grades = [], []
    for _ in range(n):
        g = int(rng.integers(0, 3))
        texts.append(" ".join([*rng.choice(words[10 * g : 10 * g + 14], 6), *rng.choice(words, 20), *["##"] * (2 - g)]))
        grades.append(g)
    return texts, np.array(grades)


def test_fit_is_the_optimum():
    """Numerical slopes of the penalised likelihood on a dense matrix."""
    rng = np.random.default_rng(4)
    texts, grade = graded_texts(rng)
    texts = [x.replace(" ##", "") for x in texts]
    grade = np.where(rng.random(len(grade)) < 0.3, rng.integers(0, 3, len(grade)), grade)  # noise, so that the optimum is finite
    index, row = quality.distinct(*quality.features(*textnum.column_bytes(pa.array(texts))))
    model = quality.fit(index, row, grade, 3, steps=4000)
    used, col = np.unique(index, return_inverse=True)
    x = np.zeros((len(texts), len(used)))
    x[row, col] = 1
    penalty, weight = quality.penalties(index, row, grade, 3)[used], quality.row_weights(grade, 3)

    def loss(w, theta):
        f = 1 / (1 + np.exp(-(theta - (x @ w)[:, None])))
        f = np.column_stack([np.zeros(len(f)), f, np.ones(len(f))])
        i = np.arange(len(f))
        return weight @ -np.log(f[i, grade + 1] - f[i, grade]) + 3e-5 / 2 * w @ w

    w, theta = model.weights[used], model.thresholds
    unit, tiny = np.eye(len(used)), 1e-5
    slope = np.array([(loss(w + tiny * e, theta) - loss(w - tiny * e, theta)) / (2 * tiny) for e in unit])
    # the convex optimum: no slope beyond the penalty, and the penalty met where a weight is not zero
    assert (np.abs(slope) <= penalty + 2e-4).all()
    assert np.abs(slope + penalty * np.sign(w))[w != 0].max() < 2e-4
    assert max(abs(loss(w, theta + tiny * e) - loss(w, theta - tiny * e)) / (2 * tiny) for e in np.eye(2)) < 2e-4
    assert 5 < (w != 0).sum() < len(w)


def test_scores_against_word_by_word(spark):
    """Every text scored alone, word by word, from the weights; the query's operator gives the same."""
    rng = np.random.default_rng(6)
    texts, grades = graded_texts(rng)
    texts += [None, "", "One, two. two ** abcdefgh", "x " * 30_000, "a b"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    ratings = spark.createDataFrame([(k, int(g)) for k, g in enumerate(grades)], "doc_id long, grade int")
    model = quality.train(docs, ratings)
    whole = quality.fit(*quality.distinct(*quality.features(*textnum.column_bytes(pa.array(texts[: len(grades)])))), grades, 3)
    assert np.allclose(model.weights, whole.weights) and np.allclose(model.thresholds, whole.thresholds)

    def slot(piece, salt=1):
        raw = np.frombuffer(piece, np.uint8)
        h = int(textnum.span_hashes(raw, np.array([0]), np.array([len(raw)]), lower=True)[0]) * salt % (1 << 64)
        return (h >> (64 - quality.BITS)) + 2 * quality.SHARES

    def score(text):
        words = (text or "").encode().split()
        bare = [w[:-1] if w[-1:] in (b",", b".") and len(w) > 1 else w for w in words]
        found = {slot(w) for w in bare} | {slot(w[:n], 2 * n + 1) for w in bare for n in quality.PREFIXES if len(w) > n}
        if words:
            plain = lambda b: chr(b).isalnum() or b >= 128 or b in b",."
            step = lambda share: min(int(share * quality.SHARES), quality.SHARES - 1)
            found.add(step(sum(not all(plain(b) for b in w) for w in words) / len(words)))
            found.add(quality.SHARES + step(1 - len({w.lower() for w in bare}) / len(words)))
        return sum(np.float32(model.weights[i]) for i in found)

    for r in quality.classify(docs, model).collect():
        tails = 1 / (1 + np.exp(-(score(r.text) - model.thresholds)))
        assert r.expected_grade == pytest.approx(tails.sum(), abs=1e-5) and r.tail_probability == pytest.approx(tails[-1], abs=1e-5)
        assert r.keep == (r.tail_probability >= 0.5)


def test_several_texts_of_a_rated_id(spark):
    """The same one counts, whatever the order of rows."""
    rows = [(k, f"word{k % 3} same {k}") for k in range(30)] + [(5, "another text")] * 40
    ratings = spark.createDataFrame([(k, k % 3) for k in range(30)], "doc_id long, grade int")
    one, two = (quality.train(spark.createDataFrame(x, "doc_id long, text string").repartition(3), ratings) for x in (rows, rows[::-1]))
    assert (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, rated = spark.read.parquet(f"{sf}/documents.parquet"), quality.rate(spark.read.parquet(f"{sf}/labels.parquet"))
    model = quality.train(docs, rated.filter("doc_id % 5 <> 0"))
    rows = quality.classify(docs.select("doc_id", "text"), model).join(rated.filter("doc_id % 5 = 0"), "doc_id").select("grade", "keep", "expected_grade").collect()
    clean = [r.keep for r in rows if r.grade == 2]
    toxic = [r.keep for r in rows if r.grade == 1]
    poor = [r.keep for r in rows if r.grade == 0]
    assert np.mean(clean) > 0.96 and np.mean(toxic) < 0.2 and np.mean(poor) < 0.02


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b", "k"), (2, None, "k"), (3, "", "k"), (None, "x " * 50_000, "k"), (1, "a b", "k")], "doc_id long, text string, keep string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, quality.train(docs, quality.rate(none)))
    assert out.count() == 5 and out.columns == ["doc_id", "text", "expected_grade", "tail_probability", "keep"]
    assert all(r.keep for r in out.collect())
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, None), (3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert sorted((r.doc_id, r.grade) for r in quality.rate(labels).collect()) == [(1, 0), (2, 0), (3, 1)]
    assert quality.classify(docs.limit(0), quality.train(docs.limit(0), quality.rate(labels))).count() == 0


@pytest.mark.parametrize("order", [[0, 1], [1, 0]])
def test_rows_do_not_depend_on_neighbours(order):
    texts = ["one two two ***", "three"]
    index, row = quality.features(*textnum.column_bytes(pa.array([texts[i] for i in order])))
    got = {texts[i]: sorted(index[row == k].tolist()) for k, i in enumerate(order)}
    for t in texts:
        assert got[t] == sorted(quality.features(*textnum.column_bytes(pa.array([t])))[0].tolist())
