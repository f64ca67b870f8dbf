"""Quality classifier: ordinal cumulative-link regression on hashed text.

One weight vector over hashed words is shared by all grades; ordered
thresholds turn the score s(x) into cumulative probabilities
P(grade <= k) = sigmoid(threshold_k - s(x)).  From these come the expected
grade and the tail probability P(grade >= k), by which documents are chosen.

Features are the distinct lower-cased words of the whole text and their
beginnings of 4 to 6 bytes, hashed, with a share of marked words (that hold a
sign other than a letter, digit, comma or full stop) and of repeated words in
steps.  All of them enter the fit; an adaptive lasso penalty (each feature's by
the inverse square of its log odds between grades) sets what does not help to
zero.  The model is fitted on a bounded, deterministic sample of rated documents
(``sample`` a grade, by hash of the id) in one task; everything else covers all
rows.

Defined cases: a null or empty text has no features and is scored by the
thresholds alone; a null doc_id is scored like any other and rates nothing;
several ratings of a document count as their lowest; of several texts of a rated
id one counts, the same in every run; without ratings of two grades every
document has the highest grade; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.llm import textnum, work

BITS = 18
SHARES = 32
SIZE = (1 << BITS) + 2 * SHARES
#: Bytes of text whose features are held at a time.
SLICE = 1 << 20
#: Lengths in bytes of the word beginnings that are features too.
PREFIXES = (4, 5, 6)
#: The lasso penalty of a feature is this over its squared log odds, which count as at least LEAST_ODDS.
PENALTY, LEAST_ODDS = 0.025, 0.4
#: Signs that ordinary words carry.
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b",."]] = True


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature index, row) of each row's features, repeated as words repeat; off[0] is 0."""
    rows = len(off) - 1
    starts, ends, row = textnum.word_spans(data, off)
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # words without the full stops and commas at their end
    bare = ends - np.isin(data[ends - 1], list(b",.")).astype(np.int64)
    bare = np.where(bare > starts, bare, ends)
    whole = textnum.span_hashes(data, starts, bare, lower=True)
    hashes, owners = [whole], [row]
    for n in PREFIXES:
        long = bare - starts > n
        hashes.append(textnum.span_hashes(data, starts[long], starts[long] + n, lower=True) * np.uint64(2 * n + 1))
        owners.append(row[long])
    words = np.maximum(np.bincount(row, minlength=rows), 1)
    odd = np.concatenate([[0], np.cumsum(~_PLAIN[data] & ~textnum.IS_SPACE[data])])
    marked = np.bincount(row, odd[ends] > odd[starts], rows) / words
    at = textnum.distinct_by_row(whole, row, rows)[1]
    repeated = 1.0 - np.diff(at) / words
    some = np.flatnonzero(np.diff(at))
    step = lambda x: np.minimum((np.clip(x[some], 0, 1) * SHARES).astype(np.int64), SHARES - 1)
    slots = (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64) + 2 * SHARES
    return np.concatenate([slots, step(marked), SHARES + step(repeated)]), np.concatenate([*owners, some, some])


def distinct(index: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature of a row once, rows in order."""
    key = np.unique(row.astype(np.int64) * SIZE + index)
    return key % SIZE, key // SIZE


@dataclass
class OrdinalModel:
    """weights over features, ascending thresholds between the grades 0..K."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, index: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """The sum of the weights of each row's distinct features."""
        hit = self.weights[index] != 0
        index, row = distinct(index[hit], row[hit])
        return np.bincount(row, self.weights[index], rows)

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K, one column each."""
        return 1.0 / (1.0 + np.exp(-np.clip(score[:, None] - self.thresholds, -60, 60)))


def penalties(index: np.ndarray, row: np.ndarray, grade: np.ndarray, grades: int) -> np.ndarray:
    """The lasso penalty of each feature: small where it tells grades apart, by a cut between grades or between neighbours."""
    odds = np.full(SIZE, LEAST_ODDS)
    graded = grade.astype(np.int8)[row]
    counts = np.stack([np.bincount(index[graded == k], minlength=SIZE) for k in range(grades)]).astype(float)
    docs = np.bincount(grade, minlength=grades).astype(float)
    every = range(grades)
    for k in range(1, grades):
        for high, low in ((every[k:], every[:k]), ([k], [k - 1])):
            a, b, na, nb = counts[list(high)].sum(0), counts[list(low)].sum(0), docs[list(high)].sum(), docs[list(low)].sum()
            if na and nb:
                odds = np.maximum(odds, np.abs(np.log((a + 0.5) / (na - a + 0.5)) - np.log((b + 0.5) / (nb - b + 0.5))))
    out = PENALTY / odds**2
    out[: 2 * SHARES] = 0
    return out


def row_weights(grade: np.ndarray, grades: int) -> np.ndarray:
    """Weights of documents that let grades count alike; their sum is 1."""
    out = (1.0 / np.maximum(np.bincount(grade, minlength=grades), 1))[grade]
    return out / out.sum()


def slopes(score: np.ndarray, theta: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of -log P(grade): the derivatives by the score, by the threshold above and by that below.

    P(y) = F(theta_y) - F(theta_{y-1}) with the logistic F of theta - score.
    """
    i = np.arange(len(grade))
    cum = 1.0 / (1.0 + np.exp(-np.clip(theta - score[:, None], -60, 60)))
    full = np.column_stack([np.zeros(len(grade)), cum, np.ones(len(grade))])
    dens = full * (1 - full)
    p = np.maximum(full[i, grade + 1] - full[i, grade], 1e-12)
    up, low = dens[i, grade + 1] / p, dens[i, grade] / p
    return up - low, -up, low


def fit(index: np.ndarray, row: np.ndarray, grade: np.ndarray, grades: int, ridge: float = 3e-5, steps: int = 300) -> OrdinalModel:
    """Penalised maximum likelihood by accelerated proximal gradients; weighted so that grades count alike.

    index and row are distinct features.  The objective is convex; steps are
    scaled by a bound of its curvature for each feature, so every step is safe.
    """
    n = len(grade)
    if n == 0 or len(np.unique(grade)) < 2:
        return OrdinalModel(np.zeros(SIZE), np.full(grades - 1, -60.0))
    weight = row_weights(grade, grades)
    penalty = penalties(index, row, grade, grades)
    # no derivative exceeds the weight of the documents that hold a feature: below the penalty its weight is zero for certain
    may = np.bincount(index, weight[row], SIZE) > penalty
    index, row = index[may[index]], row[may[index]]
    used, index = np.unique(index, return_inverse=True)
    penalty = penalty[used]
    # curvature by the score is at most 1/2; a document shares it among its features and thresholds
    share = 0.5 * weight * (np.bincount(row, minlength=n) + 2)
    bound = np.concatenate([np.bincount(index, share[row], len(used)) + ridge, np.full(grades - 1, share.sum())])
    x = np.concatenate([np.zeros(len(used)), np.arange(grades - 1) - 1.0])
    y, momentum = x, 1.0
    for _ in range(steps):
        w, theta = y[: len(used)], y[len(used) :]
        ds, above, below = slopes(np.bincount(row, w[index], n), theta, grade)
        g_theta = np.zeros(grades + 1)
        np.add.at(g_theta, grade + 1, weight * above)
        np.add.at(g_theta, grade, weight * below)
        grad = np.concatenate([np.bincount(index, (weight * ds)[row], len(w)) + ridge * w, g_theta[1:-1]])
        after = y - grad / bound
        cut = penalty / bound[: len(used)]
        after[: len(used)] = np.sign(after[: len(used)]) * np.maximum(np.abs(after[: len(used)]) - cut, 0)
        after[len(used) :] = np.maximum.accumulate(after[len(used) :] - 1e-6 * np.arange(grades - 1)) + 1e-6 * np.arange(grades - 1)
        if ((y - after) * bound) @ (after - x) > 0:
            momentum = 1.0  # uphill: start the acceleration anew
        later = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y, x, momentum = after + (momentum - 1) / later * (after - x), after, later
    out = np.zeros(SIZE)
    out[used] = x[: len(used)]
    return OrdinalModel(out, x[len(used) :])


def rate(labels: DataFrame) -> DataFrame:
    """Grades 0..2 from labels (doc_id, quality, toxic): poor, sound but toxic, sound and clean."""
    poor = F.coalesce(F.col("quality"), F.lit(0)) == 0
    toxic = F.coalesce(F.col("toxic"), F.lit(1)) != 0
    return labels.select("doc_id", F.when(poor, 0).when(toxic, 1).otherwise(2).alias("grade")).filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, grades: int = 3, sample: int = 3000) -> OrdinalModel:
    """Fit on at most sample rated documents of each grade (doc_id, grade)."""
    # the sample is drawn from ids alone, before any text is read
    lot = F.xxhash64("doc_id")
    by_grade = [ratings.filter(F.col("grade") == k).select("doc_id", "grade").orderBy(lot, "doc_id").limit(sample) for k in range(grades)]
    chosen = by_grade[0]
    for part in by_grade[1:]:
        chosen = chosen.unionByName(part)
    # bounded: at most sample * grades ids
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = textnum.column_bytes(batch.column("text"))
            for i, j in textnum.slices(off, SLICE):
                index, row = distinct(*features(data[off[i] : off[j]], off[i : j + 1] - off[i]))
                index = index.astype("<i4")
                at = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=j - i))])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i).cast(pa.int64()), batch.column("grade").slice(i, j - i).cast(pa.int32()), pa.array([index[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["doc_id", "grade", "features"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")  # at most sample * grades rows
        sizes = np.array([len(x.as_buffer()) // 4 for x in table["features"]], np.int64)
        index = np.concatenate([np.frombuffer(x.as_buffer(), "<i4") for x in table["features"]])
        model = fit(index, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), table["grade"].to_numpy().astype(np.int64), grades)
        at = np.flatnonzero(model.weights)
        return pa.table({"at": pa.array([at.tolist()], pa.list_(pa.int64())), "weights": pa.array([model.weights[at].tolist()], pa.list_(pa.float64())), "thresholds": pa.array([model.thresholds.tolist()], pa.list_(pa.float64()))})

    work.tune(docs.sparkSession)
    one = rows.mapInArrow(featured, "doc_id long, grade int, features binary").groupBy("doc_id").agg(F.min(F.struct("features", "grade")).alias("x"))
    model = one.select("doc_id", "x.*").groupBy(F.lit(0).alias("all")).applyInArrow(learn, "at array<long>, weights array<double>, thresholds array<double>").first()
    if model is None:
        return OrdinalModel(np.zeros(SIZE), np.full(grades - 1, -60.0))
    weights = np.zeros(SIZE)
    weights[model.at] = model.weights
    return OrdinalModel(weights, np.array(model.thresholds))


def classify(docs: DataFrame, model: OrdinalModel, threshold: float = 0.5) -> DataFrame:
    """Every row with expected_grade, tail_probability (of the top grade) and keep.

    Columns of docs with these names give way to the results.
    """
    spark = docs.sparkSession
    work.tune(spark)
    sent = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))  # SIZE floats, a constant
    extra = ["expected_grade", "tail_probability", "keep"]
    docs = docs.drop(*extra)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = OrdinalModel(*sent.value)
        for batch in batches:
            data, off = textnum.column_bytes(batch.column("text"))
            for i, j in textnum.slices(off, SLICE):
                tails = own.at_least(own.score(*features(data[off[i] : off[j]], off[i : j + 1] - off[i]), j - i))
                part = batch.slice(i, j - i)
                columns = [*part.columns, pa.array(tails.sum(1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= threshold)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *extra])

    added = [T.StructField(n, t) for n, t in zip(extra, (T.DoubleType(), T.DoubleType(), T.BooleanType()), strict=True)]
    schema = T.StructType([*docs.schema.fields, *added])
    return docs.mapInArrow(score, schema)
