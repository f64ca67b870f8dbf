"""Approximate nearest neighbours by cosine: a hash-prefix forest.

Vectors get one long hash string a tree (signs of random projections, seeded,
each tree a choice of its own from a pool).  A tree is a sorted array of those
strings.  Rows are dealt into blocks of bounded size by a hash of their id,
each with a forest of its own; the stated queries go to every block, in blocks
of their own, so no hot vector gathers in one task.  Two rounds:

1. A query descends every tree to its longest matching prefixes and ascends
   all trees together, a sign at a time, until a few distinct candidates are
   found.  The best k of all blocks give the angle that a row must beat.
2. Two vectors at that angle share a sign with a chance p, so all trees miss a
   row as near with (1 - p**x)**trees at a prefix of x signs.  The query ascends
   to the longest prefix at which this is at most ``miss``, and the rows that
   share it in some tree are ranked exactly in double precision.

Where near neighbours exist the second round stops at long prefixes and looks
at few rows; vectors without structure have no near neighbours, and there it
has to look at a large part of each block (see README for both).

Defined cases: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; null ids take no part; ties
go to the smaller id; rows with the id of the query are its own; a query id
with several vectors is asked with each, and ranks count for each; repeated
rows are candidates of their own, and ask once; fewer candidates than asked
for are all returned; an empty table has no results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.llm import work

RESULTS = "query_id long, query_key long, block long, at long, vec_id long, score double"
#: Queries by rows that are looked at together.
CELLS = 1 << 21


class Forest:
    """Sorted hash strings of the rows of a block, one array a tree."""

    def __init__(self, unit: np.ndarray, trees: int, bits: int, pool: int, seed: int):
        rng = np.random.default_rng(seed)
        self.bits, self.trees, self.rows = bits, trees, len(unit)
        self.planes = rng.standard_normal((unit.shape[1], pool))
        self.picks = np.stack([rng.choice(pool, bits, replace=False) for _ in range(trees)])
        own = self.codes(unit)
        self.order = np.argsort(own, axis=0, kind="stable").T.copy()
        self.strings = np.take_along_axis(own.T, self.order, 1)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(rows, trees) hash strings, first sign highest."""
        signs = unit @ self.planes > 0
        out = np.zeros((len(unit), self.trees), np.uint32)
        for b in range(self.bits):
            out = (out << np.uint32(1)) | signs[:, self.picks[:, b]]
        return out

    def spans(self, asked: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) in each tree of the entries that share the first depth signs with each query."""
        rest = (self.bits - depth).astype(np.uint32)[:, None]
        low = (asked >> rest) << rest
        high = low | ((np.uint32(1) << rest) - np.uint32(1))
        start, end = np.empty(low.shape, np.int64), np.empty(low.shape, np.int64)
        for t in range(self.trees):
            start[:, t] = np.searchsorted(self.strings[t], low[:, t], "left")
            end[:, t] = np.searchsorted(self.strings[t], high[:, t], "right")
        return start, end

    def mark(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mask of queries by rows of the entries in the spans."""
        out = np.zeros((len(start), self.rows), bool)
        sizes = (end - start).reshape(-1)
        ends = np.cumsum(sizes)
        entry = np.repeat(start.reshape(-1) - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        cell = np.repeat(np.arange(len(sizes)), sizes)
        out[cell // self.trees, self.order[cell % self.trees, entry]] = True
        return out

    def longest(self, asked: np.ndarray) -> int:
        """The longest prefix that any query shares with any entry: where the ascent starts."""
        best = 0
        for t in range(self.trees):
            at = np.searchsorted(self.strings[t], asked[:, t])
            for near in (np.maximum(at - 1, 0), np.minimum(at, self.rows - 1)):
                differ = int((self.strings[t][near] ^ asked[:, t]).min())
                best = max(best, self.bits - differ.bit_length())
        return best

    def ascend(self, asked: np.ndarray, want: int) -> np.ndarray:
        """Mask of the rows found when all trees are ascended together until want are."""
        out, open_ = np.zeros((len(asked), self.rows), bool), np.arange(len(asked))
        want = min(want, self.rows)
        for depth in range(self.longest(asked), -1, -1):
            start, end = self.spans(asked[open_], np.full(len(open_), depth))
            # too few even if all were distinct: go on up without marking
            ripe = np.flatnonzero(((end - start).sum(1) >= want) | (depth == 0))
            if len(ripe):
                seen = self.mark(start[ripe], end[ripe])
                done = (seen.sum(1) >= want) | (depth == 0)
                out[open_[ripe[done]]] = seen[done]
                open_ = np.delete(open_, ripe[done])
            if not len(open_):
                break
        return out

    def at_depth(self, asked: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return self.mark(*self.spans(asked, depth))


def stop_depth(score: np.ndarray, trees: int, bits: int, miss: float) -> np.ndarray:
    """The longest prefix at which all trees miss a row of that cosine with a chance of at most miss."""
    p = 1 - np.arccos(np.clip(score, -1, 1)) / np.pi
    need = 1 - miss ** (1 / trees)
    with np.errstate(divide="ignore"):
        return np.clip(np.where(p >= 1, bits, np.floor(np.log(need) / np.log(np.minimum(p, 1 - 1e-12)) + 1e-9)), 0, bits).astype(np.int64)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Times a power of two, which rounds nothing, so that squares stay finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(-1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosine(vectors: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors get equal scores."""
    vectors, q = _scaled(vectors), _scaled(q)
    return (vectors * q).sum(1) / (np.sqrt((vectors * vectors).sum(1)) * np.sqrt((q * q).sum()))


def best(forest: Forest, unit: np.ndarray, ids: np.ndarray, vectors: np.ndarray, q_ids: np.ndarray, q_vectors: np.ndarray, floor: np.ndarray | None, k: int, least: int, miss: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, row, score) of the k best candidates of each query in a block, and how many pairs were scored.

    floor is the score to beat (second round); without it, least candidates are looked at.
    """
    q_unit, rows = _unit(q_vectors), len(ids)
    asked = forest.codes(q_unit)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    scored, step = 0, max(1, CELLS // rows)
    for at in range(0, len(q_ids), step):
        part = slice(at, at + step)
        if floor is None:
            mask = forest.ascend(asked[part], least)
        else:
            mask = forest.at_depth(asked[part], stop_depth(floor[part], forest.trees, forest.bits, miss))
        mask &= ids != q_ids[part, None]
        i, j = np.nonzero(mask)
        scored += len(i)
        if len(i) * 16 > mask.size:
            # many: the whole product costs less than gathering the vectors of each pair
            near = np.where(mask, q_unit[part] @ unit.T, -np.inf)
        else:
            near = np.full(mask.shape, -np.inf)
            for x in range(0, len(i), 65536):
                p, r = i[x : x + 65536], j[x : x + 65536]
                near[p, r] = np.einsum("ij,ij->i", q_unit[at + p], unit[r])
        top = min(k, rows)
        cut = np.partition(near, rows - top, axis=1)[:, rows - top]
        i, j = np.nonzero((near >= cut[:, None] - 1e-9) & np.isfinite(near))
        edge = np.searchsorted(i, np.arange(len(mask) + 1))
        for q, (s, e) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
            if s < e:
                hit = j[s:e]
                score = cosine(vectors[hit], q_vectors[at + q])
                first = np.lexsort((ids[hit], -score))[:k]
                found.append((np.full(len(first), at + q), hit[first], score[first]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), scored
    return *(np.concatenate(c) for c in zip(*found, strict=True)), scored


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = 8192, block_queries: int = 2048, trees: int = 64, bits: int = 24, pool: int = 256, least: int = 64, miss: float = 0.05, seed: int = 11) -> DataFrame:
    """Nearest rows of vectors (vec_id, embedding) for queries (vec_id, embedding)."""
    spark = vectors.sparkSession
    work.tune(spark)

    def usable(df: DataFrame) -> DataFrame:
        e = F.col("embedding").cast("array<double>")
        fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).filter(F.col("vec_id").isNotNull() & e.isNotNull() & fine)

    base = work.folder(spark, "forest")
    rows, asked = usable(vectors), usable(queries)
    # the length that most vectors have; others cannot be compared
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).collect()  # a row a length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = sizes[0]["n"], sizes[0]["count"]
    rows = rows.filter(F.size("embedding") == width)
    asked = work.stored(asked.filter(F.size("embedding") == width).distinct().withColumn("query_key", F.xxhash64("embedding")), f"{base}/asked")
    # every block of rows meets every block of queries; neither grows with the table
    blocks, parts = max(1, -(-total // block_rows)), max(1, -(-asked.count() // block_queries))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    nothing = F.lit(None)
    own = rows.select(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).alias("block"), every(parts).alias("part"), F.lit(False).alias("asks"), "vec_id", "embedding", nothing.cast("long").alias("query_key"), nothing.cast("double").alias("floor"))

    def meet(floors: DataFrame | None) -> DataFrame:
        sent = asked.withColumn("floor", F.lit(None).cast("double")) if floors is None else asked.join(floors, ["vec_id", "query_key"], "left").withColumn("floor", F.coalesce("floor", F.lit(-1.0)))
        sent = sent.select(every(blocks).alias("block"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).alias("part"), F.lit(True).alias("asks"), "vec_id", "embedding", "query_key", "floor")
        first_round = floors is None

        def find(table: pa.Table) -> pa.Table:
            asks = table["asks"].to_numpy().astype(bool)
            if asks.all() or not asks.any():
                return out_schema.empty_table()
            x = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(asks), width)
            ids = table["vec_id"].to_numpy()
            key = table["query_key"].fill_null(0).to_numpy()
            floor = table["floor"].fill_null(0.0).to_numpy()
            # an order of its own, whatever the shuffle did
            place = np.lexsort((*x.T[::-1], ids, asks))
            x, ids, asks, key, floor = x[place], ids[place], asks[place], key[place], floor[place]
            mine, theirs = x[~asks], x[asks]
            unit = _unit(mine)
            q, r, score, _ = best(Forest(unit, trees, bits, pool, seed), unit, ids[~asks], mine, ids[asks], theirs, None if first_round else floor[asks], k, least, miss)
            block = np.full(len(q), table["block"][0].as_py(), np.int64)
            columns = [ids[asks][q], key[asks][q], block, r, ids[~asks][r], score]
            return pa.table([pa.array(c, f.type) for c, f in zip(columns, out_schema, strict=True)], schema=out_schema)

        return own.unionByName(sent).groupBy("block", "part").applyInArrow(find, RESULTS)

    out_schema = pa.schema([(c.split()[0], pa.float64() if c.endswith("double") else pa.int64()) for c in RESULTS.split(", ")])
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id", "block", "at")

    def nearest(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = work.stored(nearest(meet(None)), f"{base}/first")
    floors = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "query_key", F.col("score").alias("floor"))
    again = meet(floors).unionByName(first.drop("rank")).dropDuplicates(["query_id", "query_key", "block", "at"])
    return nearest(again).select("query_id", "rank", "vec_id", "score")
