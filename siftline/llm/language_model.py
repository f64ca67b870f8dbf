"""Language-model scoring by deleted interpolation.

An n-gram model: maximum-likelihood estimates of each order are mixed, with
weights that depend on how often the longest context was seen (buckets of its
count).  The weights come from expectation-maximisation on held-out counts:
every training token in turn is deleted from the counts and predicted by the
rest.  A final share goes to the uniform distribution over the vocabulary and
one unknown word, so no text has probability zero.

Dataflow.  Documents are packed into units of bounded size (one compressed
row each).  A unit asks for the counts of its distinct n-grams: sorted hashes,
delta-coded, dealt by the hash itself, so that a frequent n-gram is one entry
a unit and no key is hot.  A counting task adds up what the units saw in
training documents, and answers each unit with the totals in the order of its
request.  Units meet their answers once; what is kept of them are the counts
of each token's n-grams and a histogram for the fit, so that scoring reads
neither texts nor hashes again.  What travels grows with the number of distinct
n-grams of the units, not with tokens times documents.

A context needs no counts of its own: every word of a training document is
followed by exactly one token, so the context of a token is seen as often as
the shorter n-gram that ends before it, and the bare beginning as often as
there are training documents.

Defined cases: a null or empty text is the end token alone; an empty table has
an empty result; without training documents all counts are zero and both scores
are those of the uniform distribution; a repeated row counts each time; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm import textnum, work

END = np.uint64(0x5EED0E2D0F7E8701)
BEGIN = np.uint64(0x1B06A3D5B16B00B5)
#: Bytes of text in a unit, and of all texts to a counting task (of single words, eight times as many).
UNIT_BYTES, TASK_BYTES = 4 << 20, 12 << 20
#: Context-frequency buckets: 0, 1, 2, 3, 4-7, 8-15, ... doubling, as far as counts of 64 bits go.
BUCKETS = 65
#: Steps of the held-out histogram to a factor of two of a probability, and its depth: that of one in 2**63.
STEPS, DEPTH = 4, 63
BINS = STEPS * DEPTH + 2

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _packed(data: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(data).tobytes(), codec="zstd", asbytes=True)


def _deltas(sorted_hashes: np.ndarray) -> bytes:
    """Sorted 64-bit hashes as byte planes of their differences."""
    d = np.diff(sorted_hashes, prepend=np.uint64(0)).astype("<u8")
    planes = d.view(np.uint8).reshape(-1, 8).T
    used = next((k for k in range(8, 0, -1) if planes[k - 1].any()), 1) if len(d) else 1
    return bytes([used]) + b"".join(np.ascontiguousarray(planes[k]).tobytes() for k in range(used))


def _undeltas(raw) -> np.ndarray:
    used = memoryview(raw)[0]
    flat = np.frombuffer(raw, np.uint8, offset=1)
    n = len(flat) // used
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :used] = flat.reshape(used, n).T
    return np.cumsum(planes.reshape(-1).view("<u8"), dtype=np.uint64)


def _counts_packed(c: np.ndarray) -> bytes:
    """Counts as bytes, those above 254 apart."""
    big = c > 254
    small = np.where(big, 255, c).astype(np.uint8)
    body = small.tobytes() + c[big].astype("<i8").tobytes()
    return len(c).to_bytes(8, "little") + len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _counts_unpacked(raw) -> np.ndarray:
    raw = memoryview(raw)
    n, size = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:16], "little")
    body = pa.decompress(pa.py_buffer(raw[16:]), decompressed_size=size, codec="zstd", asbytes=True)
    out = np.frombuffer(body, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(body, "<i8", offset=n)
    return out


def training(doc_id: pa.Array, folds: int, held: int) -> np.ndarray:
    """Whether a document trains: crc32 of its id as text, modulo folds, is not held."""
    return np.array([zlib.crc32(str(i).encode()) % folds != held if i is not None else True for i in doc_id.to_pylist()], bool)


def _units(docs: DataFrame, unit_bytes: int) -> DataFrame:
    """Pack rows into units: one row each, the texts compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        ids: list[pa.Array] = []
        texts: list[bytes] = []
        sizes: list[np.ndarray] = []
        held = 0

        def row() -> pa.RecordBatch:
            nonlocal ids, texts, sizes, held, made
            one = pa.record_batch([pa.concat_arrays(ids), pa.array(np.concatenate(sizes))], names=["doc_id", "size"])
            body = b"".join(texts)
            out = pa.RecordBatch.from_arrays(
                [pa.array([(part << 24) + made], pa.int64()), pa.array([_ipc(one)], pa.binary()), pa.array([len(body)], pa.int64()), pa.array([pa.compress(body, codec="zstd", asbytes=True)], pa.binary())],
                names=["unit", "rows", "size", "body"],
            )
            ids, texts, sizes, held, made = [], [], [], 0, made + 1
            return out

        for batch in batches:
            doc_id = batch.column("doc_id").cast(pa.int64())
            data, off = textnum.column_bytes(batch.column("text"))
            for i, j in textnum.slices(off):
                if held and held + off[j] - off[i] > unit_bytes:
                    yield row()
                ids.append(doc_id.slice(i, j - i))
                texts.append(data[off[i] : off[j]].tobytes())
                sizes.append(np.diff(off[i : j + 1]))
                held += int(off[j] - off[i])
        if ids:
            yield row()

    return docs.select("doc_id", "text").mapInArrow(pack, "unit long, rows binary, size long, body binary")


def _tokens_of(rows, size: int, body) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(doc_id, token hashes with an end token a document, row of each token)."""
    table = _from_ipc(rows)
    doc_id = table["doc_id"].combine_chunks()
    data = np.frombuffer(pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    off = np.concatenate([[0], np.cumsum(table["size"].to_numpy())])
    hashes, at = [], []
    for i, j in textnum.slices(off):
        h, row = textnum.word_hashes(data[off[i] : off[j]], off[i : j + 1] - off[i])
        ends = np.searchsorted(row, np.arange(j - i), "right")
        hashes.append(np.insert(h, ends, END))
        at.append(np.insert(row, ends, np.arange(j - i)) + i)
    if not hashes:
        return doc_id, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return doc_id, np.concatenate(hashes), np.concatenate(at)


def _grams(h: np.ndarray, row: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order the hash of the n-gram that ends at each token.

    A document begins with order - 1 begin marks, so each token has one n-gram
    of every order.
    """
    out = [h]
    acc = h
    for k in range(1, order):
        prev = np.full(len(h), BEGIN, np.uint64)
        prev[k:] = np.where(row[k:] == row[:-k], h[:-k], BEGIN)
        acc = textnum.mix(acc * np.uint64(0x9E3779B185EBCA87) + prev + np.uint64(k))
        out.append(acc)
    return out


def _requests(units: DataFrame, order: int, folds: int, held: int, deals: list[int]) -> DataFrame:
    """Each unit's distinct n-grams with its training counts, by order and counting task."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, rows, size, body in zip(*(batch.column(c) for c in ("unit", "rows", "size", "body")), strict=True):
                unit = unit.as_py()
                doc_id, h, row = _tokens_of(rows.as_buffer(), size.as_py(), body.as_buffer())
                trains = training(doc_id, folds, held)[row] if len(row) else np.zeros(0, bool)
                for kind, key in enumerate(_grams(h, row, order)):
                    uniq, inverse = np.unique(key, return_inverse=True)
                    seen = np.bincount(inverse, trains, len(uniq)).astype(np.int64)
                    del inverse
                    width = np.uint64(((1 << 64) - 1) // deals[kind] + 1) if deals[kind] > 1 else None
                    task = (uniq // width).astype(np.int64) if width is not None else np.zeros(len(uniq), np.int64)
                    # only tasks that are asked for anything
                    some, first = np.unique(task, return_index=True)
                    parts = list(zip(first.tolist(), [*first[1:].tolist(), len(uniq)], strict=True))
                    n = len(parts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([unit] * n, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array(some, pa.int64()), pa.array([_deltas(uniq[x:y]) for x, y in parts], pa.binary()), pa.array([_counts_packed(seen[x:y]) for x, y in parts], pa.binary())],
                        names=["unit", "kind", "task", "keys", "counts"],
                    )

    return units.mapInArrow(ask, "unit long, kind int, task long, keys binary, counts binary")


def _answers(requests: DataFrame) -> DataFrame:
    """Add up the counts of each n-gram over all units; answer each unit in its order."""

    def answer(table: pa.Table) -> pa.Table:
        kind, task = table["kind"][0].as_py(), table["task"][0].as_py()
        keys = [_undeltas(x.as_buffer()) for x in table["keys"]]
        sizes = [len(k) for k in keys]
        uniq, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        counts = np.concatenate([_counts_unpacked(x.as_buffer()) for x in table["counts"]])
        total = np.bincount(inverse, counts, len(uniq)).astype(np.int64)
        ends = np.cumsum(sizes)
        told = [_counts_packed(total[inverse[e - n : e]]) for n, e in zip(sizes, ends.tolist(), strict=True)]
        distinct = int(np.count_nonzero(total)) if kind == 0 else 0
        words = int(total.sum()) if kind == 0 else 0
        n = len(sizes)
        return pa.table(
            [table["unit"], pa.array([kind] * n, pa.int32()), pa.array([task] * n, pa.int64()), pa.array(told, pa.binary()), pa.array([distinct] + [0] * (n - 1), pa.int64()), pa.array([words] + [0] * (n - 1), pa.int64())],
            names=["unit", "kind", "task", "totals", "vocabulary", "words"],
        )

    return requests.groupBy("kind", "task").applyInArrow(answer, "unit long, kind int, task long, totals binary, vocabulary long, words long")


def _indexed(c: np.ndarray) -> bytes:
    """Numbers as ranks among the distinct ones, the most frequent first, in byte planes."""
    uniq, inverse, n = np.unique(c, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(uniq), np.uint32)
    rank[order] = np.arange(len(uniq), dtype=np.uint32)
    planes = rank[inverse].astype("<u4").view(np.uint8).reshape(-1, 4).T
    used = max(1, (max(len(uniq) - 1, 0).bit_length() + 7) // 8)
    body = uniq[order].astype("<i8").tobytes() + b"".join(np.ascontiguousarray(planes[k]).tobytes() for k in range(used))
    head = b"".join(x.to_bytes(8, "little") for x in (len(c), len(uniq), used, len(body)))
    return head + pa.compress(body, codec="zstd", asbytes=True)


def _from_index(raw) -> np.ndarray:
    raw = memoryview(raw)
    n, distinct, used, size = (int.from_bytes(raw[8 * k : 8 * k + 8], "little") for k in range(4))
    body = pa.decompress(pa.py_buffer(raw[32:]), decompressed_size=size, codec="zstd", asbytes=True)
    planes = np.zeros((n, 4), np.uint8)
    for k in range(used):
        planes[:, k] = np.frombuffer(body, np.uint8, n, 8 * distinct + k * n)
    return np.frombuffer(body, "<i8", distinct)[planes.reshape(-1).view("<u4")]


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_ipc(raw) -> pa.Table:
    with pa.ipc.open_stream(raw) as r:
        return r.read_all().combine_chunks()


def _bucket(context: np.ndarray) -> np.ndarray:
    """0, 1, 2, 3, then one a doubling."""
    c = np.maximum(context, 0)
    return np.where(c < 4, c, np.minimum(np.log2(np.maximum(c, 1)).astype(np.int64) + 2, BUCKETS - 1))


def _estimates(grams: list[np.ndarray], row: np.ndarray, words: int, delete: bool) -> tuple[list[np.ndarray], np.ndarray]:
    """Maximum-likelihood estimates by order, and the bucket; with delete, without the token itself.

    grams[n - 1] has the training count of the n-gram that ends at each token.
    """
    less = 1 if delete else 0
    ests = [np.maximum(grams[0] - less, 0) / max(words - less, 1)]
    context = None
    inner = np.zeros(len(row), bool)
    inner[1:] = row[1:] == row[:-1]
    for n in range(2, len(grams) + 1):
        # the n-gram before, or the bare beginning, which the end token of each document counts
        before = np.empty_like(grams[0])
        before[1:] = grams[n - 2][:-1]
        last = np.append(~inner[1:], True)
        before[~inner] = grams[0][last]
        context = np.maximum(before - less, 0)
        ests.append(np.where(context > 0, np.maximum(grams[n - 1] - less, 0) / np.maximum(context, 1), 0.0))
    bucket = _bucket(context) if context is not None else np.zeros(len(row), np.int64)
    return ests, bucket


def _bins(p: np.ndarray) -> np.ndarray:
    """0 for none, else the step of -log2, at most the last."""
    with np.errstate(divide="ignore"):
        step = np.floor(-np.log2(p) * STEPS + 0.5)
    return np.where(p > 0, np.minimum(step, BINS - 2) + 1, 0).astype(np.int64)


def fit_weights(hist: list[tuple[int, list[int], int]], order: int, vocabulary: int, rounds: int = 60) -> np.ndarray:
    """Expectation-maximisation on (bucket, bins of the estimates, held-out count).

    Returns weights[bucket] over the uniform share and orders 1..order.  A bucket
    without held-out counts takes those of all; without any, all is uniform.
    """
    if not hist:
        return np.tile(np.eye(order + 1)[0], (BUCKETS, 1))
    bucket = np.array([b for b, _, _ in hist])
    bins = np.array([x for _, x, _ in hist])
    count = np.array([c for _, _, c in hist], float)
    est = np.where(bins > 0, 2.0 ** (-(bins - 1) / STEPS), 0.0)
    est = np.column_stack([np.full(len(bins), 1.0 / (vocabulary + 1)), est])

    def learn(mask: np.ndarray) -> np.ndarray:
        w, e, c = np.full(order + 1, 1.0 / (order + 1)), est[mask], count[mask]
        for _ in range(rounds):
            part = e * w
            share = part / part.sum(1, keepdims=True)
            w = (share * c[:, None]).sum(0) / c.sum()
            w = np.maximum(w, 1e-9)
            w /= w.sum()
        return w

    overall = learn(np.ones(len(bucket), bool))
    return np.array([learn(bucket == b) if (bucket == b).any() else overall for b in range(BUCKETS)])


def score_documents(docs: DataFrame, order: int = 2, folds: int = 7, held: int = 2, unit_bytes: int = UNIT_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Score every document of (doc_id, text) with a model of those not held out."""
    spark = docs.sparkSession
    work.tune(spark)
    base = work.folder(spark, "lm")
    units = work.stored(_units(docs, unit_bytes), f"{base}/units")
    # counting tasks grow with the texts, whatever the number of partitions
    bulk = units.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    deals = [max(1, bulk // (task_bytes * (1 if n else 8))) for n in range(order)]
    answers = work.stored(_answers(_requests(units, order, folds, held, deals)), f"{base}/answers")
    vocabulary, words = answers.agg(F.coalesce(F.sum("vocabulary"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()

    nothing = F.lit(None)
    told = units.select("unit", "rows", "size", "body", nothing.cast("int").alias("kind"), nothing.cast("long").alias("task"), nothing.cast("binary").alias("totals")).unionByName(
        answers.select("unit", nothing.cast("binary").alias("rows"), nothing.cast("long").alias("size"), nothing.cast("binary").alias("body"), "kind", "task", "totals")
    )

    def meet(table: pa.Table) -> pa.Table:
        own = table.filter(table["body"].is_valid())
        doc_id, h, row = _tokens_of(*(own[c][0].as_buffer() if c != "size" else own[c][0].as_py() for c in ("rows", "size", "body")))
        answer = table.filter(table["totals"].is_valid()).sort_by([("kind", "ascending"), ("task", "ascending")])
        kinds = answer["kind"].to_numpy()
        grams = []
        for kind, key in enumerate(_grams(h, row, order)):
            inverse = np.unique(key, return_inverse=True)[1]
            at = np.flatnonzero(kinds == kind).tolist()
            grams.append(np.concatenate([_counts_unpacked(answer["totals"][i].as_buffer()) for i in at])[inverse] if at else np.zeros(0, np.int64))
        ests, bucket = _estimates(grams, row, words, True)
        key = bucket
        for e in ests:
            key = key * BINS + _bins(e)
        uniq, n = np.unique(key[training(doc_id, folds, held)[row]] if len(row) else key, return_counts=True)
        told_rows = pa.record_batch([doc_id, pa.array(np.bincount(row, minlength=len(doc_id)).astype(np.int64))], names=["doc_id", "n_tokens"])
        seen = pa.record_batch([pa.array(uniq.astype(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])
        return pa.table({"rows": pa.array([_ipc(told_rows)], pa.binary()), "grams": pa.array([[_indexed(g) for g in grams]], pa.list_(pa.binary())), "seen": pa.array([_ipc(seen)], pa.binary())})

    met = work.stored(told.groupBy("unit").applyInArrow(meet, "rows binary, grams array<binary>, seen binary"), f"{base}/met")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("seen"):
                yield from _from_ipc(raw.as_buffer()).to_batches()

    # at most BUCKETS * BINS ** order rows, whatever the corpus
    seen = met.select("seen").mapInArrow(unpack, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").collect()
    hist = []
    for key, n in seen:
        bins = []
        for _ in range(order):
            key, b = divmod(key, BINS)
            bins.append(b)
        hist.append((key, bins[::-1], n))
    weights = fit_weights(hist, order, vocabulary)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for told_rows, packed in zip(batch.column("rows"), batch.column("grams"), strict=True):
                table = _from_ipc(told_rows.as_buffer())
                doc_id, size = table["doc_id"].combine_chunks(), table["n_tokens"].to_numpy()
                rows = len(size)
                row = np.repeat(np.arange(rows), size)
                grams = [_from_index(g.as_buffer()) for g in packed.values]
                ests, bucket = _estimates(grams, row, words, False)
                w = weights[bucket]
                p = w[:, 0] / (vocabulary + 1)
                for k, e in enumerate(ests):
                    p = p + w[:, k + 1] * e
                plain = np.log10((grams[0] + 1) / (words + vocabulary + 1))
                out = {
                    "doc_id": doc_id,
                    "held_out": pa.array(~training(doc_id, folds, held)),
                    "n_tokens": pa.array(size),
                    "n_known": pa.array(np.bincount(row, grams[0] > 0, rows).astype(np.int64)),
                    "train_tokens": pa.array(np.full(rows, words, np.int64)),
                    "base_score": pa.array(np.bincount(row, plain, rows)),
                    "score": pa.array(np.bincount(row, np.log10(p), rows)),
                }
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return met.select("rows", "grams").mapInArrow(score, SCORES)
