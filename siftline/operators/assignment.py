"""Minimum-cost assignment of slots to rows, and the pilot's selection on top.

The solver is the successive-shortest-path form of the Hungarian method on
integer costs (Kuhn 1955, Jonker and Volgenant 1987), one slot at a time.  The
candidates of a pilot are cut down per slot before they meet in one task: an
optimal assignment of n slots only ever needs each slot's n cheapest rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftline.functions import lexicons as L
from siftline.operators import groups

SCALE = 1_000_000


def assign(costs: Sequence[dict[str, int]]) -> list[str | None]:
    """The row of each slot, all different, at the least total; None where no row is left.

    costs[slot] maps row ids to integer costs.  Each slot in turn finds the
    shortest augmenting path over reduced costs (Dijkstra with a heap).
    """
    slot_price = [0] * len(costs)
    row_price: dict[str, int] = {}
    owner: dict[str, int] = {}
    taken: list[str | None] = [None] * len(costs)
    for slot in range(len(costs)):
        best: dict[str, int] = {}
        came: dict[str, int] = {}
        done: dict[str, int] = {}
        heap: list[tuple[int, str]] = []
        at, base, end, last = slot, 0, None, 0
        while end is None:
            for row, cost in costs[at].items():
                if row in done:
                    continue
                reach = base + cost - slot_price[at] - row_price.get(row, 0)
                if reach < best.get(row, reach + 1):
                    best[row], came[row] = reach, at
                    heapq.heappush(heap, (reach, row))
            while heap and (heap[0][1] in done or heap[0][0] > best[heap[0][1]]):
                heapq.heappop(heap)
            if not heap:
                break
            base, row = heapq.heappop(heap)
            done[row], last = base, base
            if row in owner:
                at = owner[row]
            else:
                end = row
        if end is None:
            continue
        slot_price[slot] += last
        for row, reach in done.items():
            if row in owner:
                slot_price[owner[row]] += last - reach
            row_price[row] = row_price.get(row, 0) - (last - reach)
        while end is not None:
            at = came[end]
            owner[end], taken[at], end = at, end, taken[at]
    return taken


def slots(spark: SparkSession) -> DataFrame:
    """The 24 slots of the fixed policy."""
    rows = []
    for h in L.SLOT_HARNESSES:
        for e in L.SLOT_EXECUTIONS:
            for r in L.SLOT_ROLES:
                rows += [(f"base-{len(rows) + i + 1:02d}", h, e, r, x, "any") for i, x in enumerate(L.SLOT_EXPECTATIONS)]
    places = [(h, e, r) for h in L.SLOT_HARNESSES for e in L.SLOT_EXECUTIONS for r in L.SLOT_ROLES]
    rows += [(f"mixed-{i + 1:02d}", *p, L.SLOT_EXPECTATIONS[i % 2], "mixed_work") for i, p in enumerate(places)]
    return spark.createDataFrame(rows, "slot_id string, harness string, execution_kind string, artifact_role string, learning_expectation string, workload_class string")


def distance(slot: str = "s", row: str = "r") -> Column:
    """Sum of the weights of the dimensions that differ, any differing from nothing."""
    out = F.lit(0)
    for name, weight in L.SLOT_WEIGHTS.items():
        wanted = F.col(f"{slot}.{name}")
        out = out + F.when((wanted != "any") & ~wanted.eqNullSafe(F.col(f"{row}.{name}")), weight).otherwise(0)
    return out


def cost_matrix(slot_rows: DataFrame, rows: DataFrame) -> DataFrame:
    """slot_id, packet_id, distance, choice_rank, cost for every slot and row.

    The slots are a fixed 24-row table, so broadcasting them is bounded.
    """
    pairs = rows.alias("r").crossJoin(F.broadcast(slot_rows).alias("s"))
    pairs = pairs.select(F.col("s.slot_id"), F.col("r.packet_id"), distance().alias("distance"), F.sha2(F.concat(F.col("s.slot_id"), F.lit("\0"), F.col("r.packet_id")), 256).alias("choice"))
    ranked = groups.hash_ranks(pairs, "choice", ["slot_id"]).withColumn("choice_rank", F.col("rank").cast("int")).drop("rank", "n")
    return ranked.withColumn("cost", F.col("distance").cast("long") * SCALE + F.col("choice_rank")).drop("choice")


def select_pilot(slot_rows: DataFrame, rows: DataFrame) -> DataFrame:
    """slot_id, packet_id, distance: the globally cheapest assignment of all slots."""
    matrix = cost_matrix(slot_rows, rows)
    n = slot_rows.count()
    near = Window.partitionBy("slot_id").orderBy("cost", "packet_id")
    # at most n * n rows reach the solver, whatever the corpus
    matrix = matrix.withColumn("k", F.row_number().over(near)).filter(F.col("k") <= n).drop("k")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(pdf["slot_id"].unique())
        costs = [dict(zip(g["packet_id"], g["cost"].astype(int), strict=True)) for _, g in pdf.sort_values("packet_id").groupby("slot_id")]
        chosen = pd.DataFrame({"slot_id": names, "packet_id": assign(costs)}).dropna()
        return chosen.merge(pdf[["slot_id", "packet_id", "distance"]], on=["slot_id", "packet_id"])

    return matrix.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(solve, "slot_id string, packet_id string, distance int")


def select_greedy(slot_rows: Sequence[dict], rows: Sequence[dict]) -> list[tuple[str, str]]:
    """With fewer rows than slots: each slot in order takes its nearest row left (driver-side, < 24 rows)."""
    import hashlib

    left, out = {r["packet_id"]: r for r in rows}, []
    for s in slot_rows:
        if not left:
            break

        def key(r: dict, s: dict = s) -> tuple:
            differ = tuple(n for n in L.SLOT_WEIGHTS if s[n] not in ("any", r.get(n)))
            return (sum(L.SLOT_WEIGHTS[n] for n in differ), differ, hashlib.sha256(f"{s['slot_id']}\0{r['packet_id']}".encode()).hexdigest())

        best = min(left.values(), key=key)
        out.append((s["slot_id"], best["packet_id"]))
        del left[best["packet_id"]]
    return out
