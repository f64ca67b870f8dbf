"""N-gram Jaccard join with Bayesian pruning.

Links are pairs of documents whose sets of five-word shingles have a Jaccard
similarity of at least 0.8.  Steps:

1. Each document gives a hash of its shingle set, MinHash values, and nothing
   else that is kept.  Equal sets form a class; one of each goes on.
2. Classes that share a band of MinHash values meet (miss probability at the
   threshold: (1 - t**r)**b, 3e-6 with the defaults).  Each class is tied to
   the smallest of its band, never to all others, and connected components of
   these ties bound which classes can link.
3. Classes are compared in blocks: those of a component with each other, or,
   where that is more work (components that chain many bands together), those
   of each band, a pair in the first band that it shares.  MinHash values are
   compared a few at a time, and a pair is dropped as soon as the posterior
   probability that it reaches the threshold, given the matches so far and a
   uniform prior, falls below the tolerance.  The pairs left are verified on
   the shingle sets themselves.  A block gives link counts and a spanning
   forest of its links; pairs are never emitted.
4. Connected components of the verified links are the duplicate groups.

Words are lower-cased (A-Z) runs outside 0x20 and 0x09-0x0D; a text of one to
four words has one shingle of all its words.

Defined cases: texts without words link to nothing; rows with a null doc_id
link like others, and the class of a group is its smallest id that is not null
(null where it has none); one id on several texts is several documents;
repeated rows are copies of each other; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm import textnum, work

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
WORDS = 5
THRESHOLD = 0.8
#: Classes of a component compared in one block, and MinHash values a step.
BLOCK, STEP = 512, 16
#: Bytes of shingles of a block, about.
BLOCK_BYTES = 32 << 20
#: Keys with more than this part of all rows are joined apart, by broadcast; there are fewer than that.
LARGE = 1000
#: What a text with words holds.
WORDED = r"[^\x20\x09-\x0D]"

_rng = np.random.default_rng(20240607)
_MUL = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, with offsets."""
    h, row = textnum.word_hashes(data, off)
    return textnum.distinct_by_row(*textnum.ngram_hashes(h, row, words, short=True), len(off) - 1)


def minhashes(shingles: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, HASHES) MinHash values; rows without shingles have the largest value."""
    rows = len(off) - 1
    out = np.full((rows, HASHES), np.iinfo(np.uint32).max, np.uint32)
    some = np.flatnonzero(np.diff(off))
    if not len(some):
        return out
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    begin = off[some]
    for k in range(HASHES):
        out[some, k] = np.minimum.reduceat(x * _MUL[k] + _ADD[k], begin)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(rows, BANDS) keys of the bands of MinHash values."""
    s = sig.astype(np.uint64).reshape(len(sig), BANDS, ROWS)
    key = np.zeros((len(sig), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = textnum.mix(key * np.uint64(0x9E3779B185EBCA87) + s[:, :, r])
    return key.view(np.int64)


def fewest_matches(threshold: float, tolerance: float) -> list[int]:
    """For n compared values, the fewest matches whose posterior chance of a link is at least tolerance.

    With a uniform prior, P(s >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(HASHES + 1):
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
        out.append(m)
    return out


def likely_pairs(a: np.ndarray, b: np.ndarray, same: bool, fewest: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a and b that survive the incremental comparison (i < j if same)."""
    count = np.zeros((len(a), len(b)), np.uint8)
    for k in range(STEP):
        count += a[:, k, None] == b[None, :, k]
    keep = count >= fewest[STEP]
    if same:
        keep = np.triu(keep, 1)
    i, j = np.nonzero(keep)
    matched = count[i, j].astype(np.int64)
    for k in range(STEP, HASHES, STEP):
        if not len(i):
            break
        parts = [(a[i[x : x + 65536], k : k + STEP] == b[j[x : x + 65536], k : k + STEP]).sum(1) for x in range(0, len(i), 65536)]
        matched = matched + np.concatenate(parts)
        keep = matched >= fewest[k + STEP]
        i, j, matched = i[keep], j[keep], matched[keep]
    return i, j


def first_shared(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first band whose values are equal in a[i] and b[j]; BANDS if none."""
    out = np.full(len(i), BANDS)
    for x in range(0, len(i), 65536):
        p, q = i[x : x + 65536], j[x : x + 65536]
        for k in range(BANDS - 1, -1, -1):
            at = slice(k * ROWS, (k + 1) * ROWS)
            out[x : x + 65536][(a[p, at] == b[q, at]).all(1)] = k
    return out


def shared_counts(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """|A_i & B_j| of each pair, exactly."""
    out = np.zeros(len(i), np.int64)
    if len(i) > 8 * (len(a) + len(b)):
        # dense: products of membership matrices, a run of the common shingles at a time
        both = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)
        total = np.zeros((len(a), len(b)), np.float32)
        for at in range(0, len(both), 8192):
            part = both[at : at + 8192]

            def member(sets: list[np.ndarray], part: np.ndarray = part) -> np.ndarray:
                m = np.zeros((len(sets), len(part)), np.float32)
                for r, s in enumerate(sets):
                    own = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
                    at = np.searchsorted(part, own)
                    m[r, at[part[at] == own]] = 1
                return m

            total += member(a) @ member(b).T
        return total[i, j].astype(np.int64)
    for p, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        s, t = (a[x], b[y]) if len(a[x]) <= len(b[y]) else (b[y], a[x])
        at = np.minimum(np.searchsorted(t, s), len(t) - 1)
        out[p] = np.count_nonzero(t[at] == s)
    return out


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a spanning forest of n nodes."""
    root, out = list(range(n)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((x, y))
    return out


def _text_key() -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64("text")


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, node (hash of the shingle set, null without words), size (shingles), sig."""
    work.tune(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column("doc_id").cast(pa.int64())
            data, off = textnum.column_bytes(batch.column("text"))
            for i, j in textnum.slices(off):
                sets, at = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i])
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textnum.mix(sets), dtype=np.uint64)])
                size = np.diff(at)
                node = textnum.mix(total[at[1:]] - total[at[:-1]] + size.astype(np.uint64)).view(np.int64)
                sig = minhashes(sets, at)
                columns = [doc_id.slice(i, j - i), batch.column("text_key").slice(i, j - i), pa.array(node, mask=size == 0), pa.array(size), pa.array([x.tobytes() for x in sig], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "node", "size", "sig"])

    return docs.select("doc_id", "text", _text_key().alias("text_key")).mapInArrow(sign, "doc_id long, text_key long, node long, size long, sig binary")


def by_node(edges: DataFrame, told: DataFrame, key: str = "u") -> DataFrame:
    """edges joined with told (one row a key).

    The sides meet by the complement of the key: told comes from an aggregation
    by the key itself, and only a join with exchanges of its own lets Spark
    split the rows of a frequent key.
    """
    other = told.withColumn("__key", F.bitwise_not(key)).drop(key)
    return edges.join(other, F.bitwise_not(edges[key]) == F.col("__key")).drop("__key")


def connected(edges: DataFrame, path: str, rounds: int = 64) -> DataFrame:
    """(a, b) to (node, comp): comp is the smallest node that can be reached.

    Alternates large-star and small-star steps; every round is written out.
    Raises if the rounds do not suffice (they grow with the logarithm of the nodes).
    """
    pairs = work.stored(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{path}/0")
    mark = lambda p: tuple(p.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
    state = mark(pairs)
    settled, turn = not state[0], 0
    while not settled:
        turn += 1
        if turn >= rounds:
            raise RuntimeError(f"components have not settled after {rounds} rounds")
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = by_node(both.filter("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        # small star: neighbours below and the node itself go to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = by_node(large, least).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        pairs, was = work.stored(small.filter("u != v").distinct(), f"{path}/{turn}"), state
        state = mark(pairs)
        settled = state == was
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    heads = pairs.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return nodes.unionByName(heads)


def compare_blocks(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """rows (task, comp, band, side_a, side_b, slot, node, copies, sig, shingles) to (node, other, links).

    comp is what meets: a component (band -1), or a band's value.  Rows with
    other are pairs of a spanning forest; those without give links, the number
    of documents of other classes that node links to in the block.
    """
    fewest = fewest_matches(threshold, tolerance)

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("comp", "ascending"), ("side_a", "ascending"), ("side_b", "ascending"), ("node", "ascending")])
        node, copies, slot, band = (table[c].to_numpy() for c in ("node", "copies", "slot", "band"))
        key = np.stack([table[c].to_numpy() for c in ("comp", "side_a", "side_b")], 1)
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(len(node), HASHES)
        raw = table["shingles"].combine_chunks()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        out_node, out_other, out_links = [], [], []
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(node)], strict=True):
            own = np.arange(s, e)
            own = own[np.concatenate([[True], node[own][1:] != node[own][:-1]])]  # a class counts once
            a_side, b_side = key[s, 1], key[s, 2]
            a, b = own[slot[own] == a_side], own[slot[own] == b_side]
            i, j = likely_pairs(sig[a], sig[b], a_side == b_side, fewest)
            if band[s] >= 0 and len(i):
                first = first_shared(sig[a], sig[b], i, j) == band[s]
                i, j = i[first], j[first]
            if not len(i):
                continue
            used_a, i = np.unique(i, return_inverse=True)
            used_b, j = np.unique(j, return_inverse=True)
            a, b = a[used_a], b[used_b]
            sets_a = [np.frombuffer(raw[int(x)].as_py(), np.uint64) for x in a]
            sets_b = [np.frombuffer(raw[int(x)].as_py(), np.uint64) for x in b]
            inter = shared_counts(sets_a, sets_b, i, j)
            union = np.array([len(x) for x in sets_a])[i] + np.array([len(x) for x in sets_b])[j] - inter
            linked = inter >= threshold * union - 1e-9
            i, j = i[linked], j[linked]
            if not len(i):
                continue
            uniq, at = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
            links = np.bincount(at, np.concatenate([copies[b[j]], copies[a[i]]]), len(uniq)).astype(np.int64)
            out_node.append(node[uniq])
            out_other.append(np.full(len(uniq), np.iinfo(np.int64).min))
            out_links.append(links)
            tree = _forest(len(uniq), at[: len(i)], at[len(i) :])
            out_node.append(node[uniq[[x for x, _ in tree]]])
            out_other.append(node[uniq[[y for _, y in tree]]])
            out_links.append(np.zeros(len(tree), np.int64))
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        other = join(out_other)
        return pa.table({"node": pa.array(join(out_node), pa.int64()), "other": pa.array(other, pa.int64(), mask=other == np.iinfo(np.int64).min), "links": pa.array(join(out_links), pa.int64())})

    return rows.groupBy("task").applyInArrow(compare, "node long, other long, links long")


def _blocks(classes: DataFrame, base: str) -> DataFrame:
    """(node, comp, band, parts, slot): where each class is compared; a class may have several places."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
                node, size = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("node", "size"))
                yield pa.RecordBatch.from_arrays([pa.array(band_keys(sig).reshape(-1)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(sig))), pa.array(node), pa.array(size)], names=["key", "band", "node", "size"])

    keyed = work.stored(classes.select("node", "size", "sig").mapInArrow(bands, "key long, band int, node long, size long"), f"{base}/bands")
    sums = [F.count(F.lit(1)).alias("n"), F.sum("size").alias("bulk")]
    leaders = keyed.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead != last").drop("last")
    ties = by_node(keyed.select("key", "node"), leaders, "key").filter("node != lead")
    comps = work.stored(connected(ties.select(F.col("lead").alias("a"), F.col("node").alias("b")), f"{base}/ties"), f"{base}/comps")

    sizes = work.stored(comps.join(classes.select("node", "size"), "node").groupBy("comp").agg(*sums), f"{base}/sizes")
    wide = sizes.filter(F.col("n") > BLOCK)
    if wide.limit(1).count():
        # pairs that a large component would compare, against those that its bands would
        few = work.stored(by_node(comps, wide.select("comp"), "comp"), f"{base}/few")  # its size decides how the join below is done
        inside = work.stored(keyed.join(few, "node"), f"{base}/inside")
        buckets = inside.groupBy("comp", "key").agg(*sums).filter("n > 1")
        buckets = work.stored(buckets, f"{base}/buckets")
        pairs = lambda: F.col("n").cast("double") * F.col("n")
        in_bands = buckets.groupBy("comp").agg(F.sum(pairs()).alias("in_bands"))
        kinds = sizes.join(in_bands, "comp", "left").withColumn("chained", F.coalesce(F.col("in_bands") < pairs(), F.lit(False))).drop("in_bands")
        kinds = work.stored(kinds, f"{base}/kinds")
        whole = by_node(comps, kinds.filter("not chained").drop("chained"), "comp").withColumn("band", F.lit(-1))
        loose = buckets.join(kinds.filter("chained").select("comp"), "comp", "left_semi").drop("comp")
        apart = by_node(inside.select("key", "band", "node"), loose, "key")
        whole = whole.unionByName(apart.withColumnRenamed("key", "comp"))
    else:
        whole = by_node(comps, sizes, "comp").withColumn("band", F.lit(-1))
    # blocks of at most about BLOCK classes and BLOCK_BYTES of shingles
    parts = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bulk") * 8 / BLOCK_BYTES)).cast("long")
    placed = whole.withColumn("parts", F.greatest(parts, F.lit(1)).cast("long")).withColumn("slot", F.pmod(F.xxhash64("node", "comp"), F.col("parts")))
    return work.stored(placed.select("node", "comp", "band", "parts", "slot"), f"{base}/placed")


def _resolve(docs: DataFrame, threshold: float, tolerance: float) -> tuple[DataFrame, DataFrame, int]:
    """(doc_id, text_key, node of each row), (node, copies, n_links, head_doc, head_key of each class), rows."""
    spark = docs.sparkSession
    work.tune(spark)
    base = work.folder(spark, "near")
    signed = work.stored(signatures(docs), f"{base}/signed")
    total = signed.count()
    # equal sets have equal values, so any will do; the first document is that with the smallest id, null last
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")).alias("first")
    classes = signed.filter("node is not null").groupBy("node").agg(first, F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("sig").alias("sig"))
    classes = work.stored(classes, f"{base}/classes")

    placed = _blocks(classes, base)
    met = placed.groupBy("node").agg(F.collect_list(F.struct("comp", "band", "parts", "slot")).alias("places"))
    wanted = met.join(classes, "node").select("node", "places", "copies", "sig", F.col("first.doc_id").alias("w_doc"), F.col("first.text_key").alias("w_key"))
    texts = docs.select("doc_id", "text", _text_key().alias("text_key"))
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("text_key") == F.col("w_key")))
    texts = texts.select("text", "node", "places", "copies", "sig")
    if signed.groupBy("doc_id", "text_key").count().filter("count > 1").limit(1).count():
        texts = texts.dropDuplicates(["node"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = textnum.column_bytes(batch.column("text"))
            for i, j in textnum.slices(off):
                sets, at = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i])
                part = batch.slice(i, j - i)
                raw = [sets[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(raw, pa.binary())], names=[*kept, "shingles"])

    kept = ["node", "places", "copies", "sig"]
    place = "array<struct<comp:bigint,band:int,parts:bigint,slot:bigint>>"
    rows = texts.mapInArrow(shingled, f"node long, places {place}, copies long, sig binary, shingles binary")
    rows = rows.withColumn("place", F.explode("places")).select("node", "copies", "sig", "shingles", "place.*")
    # what is too large for one block is compared in pairs of slots, each class going to every pair of its slot
    rows = rows.withColumn("meets", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.withColumn("side_a", F.least("slot", "meets")).withColumn("side_b", F.greatest("slot", "meets"))
    # small components share tasks, about a block's worth each
    bulk = classes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] * 8
    few = max(1, placed.filter("parts = 1").count() // BLOCK, bulk // BLOCK_BYTES)
    rows = rows.withColumn("task", F.when(F.col("parts") == 1, F.concat(F.lit("c"), F.pmod(F.xxhash64("comp"), F.lit(few)))).otherwise(F.concat_ws(":", "comp", "side_a", "side_b"))).drop("meets", "parts")
    found = work.stored(compare_blocks(rows, threshold, tolerance), f"{base}/found")

    groups = work.stored(connected(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")), f"{base}/links"), f"{base}/groups")
    counted = found.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    heads = groups.join(classes.select("node", "first"), "node").groupBy("comp").agg(F.min("first").alias("head"))
    linked = by_node(groups, heads, "comp").select("node", "head")
    known = classes.select("node", "first", "copies").join(linked, "node", "left").join(counted, "node", "left")
    head = F.coalesce("head", "first")
    known = known.select("node", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), head["doc_id"].alias("head_doc"), head["text_key"].alias("head_key"))
    return signed.select("doc_id", "text_key", "node"), work.stored(known, f"{base}/known"), total


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = 1e-6) -> DataFrame:
    """One row a document: doc_id, class_id (smallest doc_id of its group), n_links."""
    rows, known, total = _resolve(docs, threshold, tolerance)
    told = known.select("node", F.col("head_doc").alias("class_id"), "n_links", "copies")
    # at most LARGE classes hold more than 1/LARGE of the rows each: their rows meet them by broadcast, so that no task gets them all
    least = total // LARGE
    large = F.broadcast(told.filter(F.col("copies") > least).limit(LARGE))
    worded = rows.filter("node is not null")
    out = worded.join(large, "node").unionByName(worded.join(large.select("node"), "node", "left_anti").join(told.filter(F.col("copies") <= least), "node"))
    alone = rows.filter("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return out.select("doc_id", "class_id", "n_links").unionByName(alone)


def keep_first(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = 1e-6) -> DataFrame:
    """One document of each group: that with the smallest doc_id, null last; those without words stay."""
    rows, known, _ = _resolve(docs, threshold, tolerance)
    base = work.folder(docs.sparkSession, "kept")
    heads = known.select("head_doc", "head_key").distinct()
    k = "__near_"  # own columns carry a prefix, so that none of docs clashes
    times = rows.groupBy(F.col("doc_id").alias(f"{k}i"), F.col("text_key").alias(f"{k}t")).agg(F.count(F.lit(1)).alias(f"{k}n")).filter(f"{k}n > 1")
    heads = heads.join(times, F.col("head_doc").eqNullSafe(F.col(f"{k}i")) & (F.col("head_key") == F.col(f"{k}t")), "left")
    heads = work.stored(heads.select(F.col("head_doc").alias(f"{k}doc"), F.col("head_key").alias(f"{k}key"), F.coalesce(f"{k}n", F.lit(1)).alias(f"{k}rows")), base)
    worded = F.coalesce(F.col("text").rlike(WORDED), F.lit(False))
    own = docs.filter(worded).withColumn(f"{k}own", _text_key())
    kept = own.join(heads, F.col("doc_id").eqNullSafe(F.col(f"{k}doc")) & (F.col(f"{k}own") == F.col(f"{k}key")))
    out = docs.filter(~worded).unionByName(kept.filter(f"{k}rows = 1").select(*docs.columns))
    if heads.filter(f"{k}rows > 1").limit(1).count():
        # the rows of one document: one of them stays
        out = out.unionByName(kept.filter(f"{k}rows > 1").dropDuplicates(["doc_id", f"{k}own"]).select(*docs.columns))
    return out
