"""Cost model and admission: token, call and wall-clock bounds before any dispatch."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions import lexicons as L


class BudgetExceeded(RuntimeError):
    """The first dimension, in order, that passes its limit."""

    def __init__(self, dimension: str, actual: int, limit: int):
        super().__init__(f"{dimension}: {actual} is above {limit}")
        self.dimension, self.actual, self.limit = dimension, actual, limit


@dataclass(frozen=True)
class Policy:
    """What a call costs besides its packets."""

    prompt_tokens: int = 800
    output_tokens: int = 5000
    concurrency: int = 2
    minutes: int = 20
    bytes_per_token: int = L.BYTES_PER_TOKEN
    retry_share: float = 0.20


def ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long")


def call_costs(total_bytes: Column, calls: Column, policy: Policy = Policy()) -> dict[str, Column]:
    """input_tokens, output_tokens, calls and wall_minutes as expressions."""
    base = ceil_div(total_bytes, policy.bytes_per_token) + calls * policy.prompt_tokens
    return {
        "input_tokens": (base + F.ceil(base * policy.retry_share)).cast("long"),
        "output_tokens": (calls * policy.output_tokens).cast("long"),
        "calls": calls.cast("long"),
        "wall_minutes": (ceil_div(calls, policy.concurrency) * policy.minutes).cast("long"),
    }


def tiered(groups: Column, full_share: float = 0.10, mixed_share: float = 0.05, small: int = 1024, large: int = 10_240, policy: Policy = Policy()) -> dict[str, Column]:
    """Classification of all groups and extraction of a share of them."""
    room = min(L.MAX_PACKET_BYTES, L.MAX_PACKET_TOKENS * policy.bytes_per_token)
    if max(small, large) > room:
        raise ValueError("an item is larger than a packet")
    per_small, per_large = room // small, room // large
    full, mixed = F.ceil(groups * full_share).cast("long"), F.ceil(groups * mixed_share).cast("long")
    stage = F.least(groups, full + mixed)
    small_calls, large_calls = ceil_div(groups, per_small), ceil_div(stage, per_large)
    out = {
        "groups": groups.cast("long"), "full_groups": full, "mixed_groups": mixed, "stage_groups": stage.cast("long"),
        "small_per_call": F.lit(per_small).cast("long"), "large_per_call": F.lit(per_large).cast("long"),
        "small_calls": small_calls, "large_calls": large_calls,
    }
    return out | call_costs(groups * small + stage * large, small_calls + large_calls, policy)


def first_breach(costs: dict[str, Column], limits: dict[str, int]) -> Column:
    """The first dimension above its limit, checked in order, or null."""
    out = F.lit(None).cast("string")
    for name in reversed(list(limits)):
        out = F.when(costs[name] > limits[name], F.lit(name)).otherwise(out)
    return out


def enforce(row: DataFrame, limits: dict[str, int]) -> None:
    """Raise before the action if the one row of costs passes a limit."""
    got = row.first().asDict()
    for name, limit in limits.items():
        if got[name] > limit:
            raise BudgetExceeded(name, got[name], limit)


def waves(calls: int, concurrency: int, minutes: int) -> int:
    return math.ceil(calls / concurrency) * minutes


def combined(stages: DataFrame) -> DataFrame:
    """One row for stages that run one after the other: sums, the least concurrency, the longest call."""
    sums = ("input_tokens", "output_tokens", "calls", "wall_minutes", "packet_bytes")
    return stages.agg(*(F.sum(c).cast("long").alias(c) for c in sums), F.min("concurrency").alias("concurrency"), F.max("per_call_minutes").alias("per_call_minutes"))


def observed_minutes(files: DataFrame, start: Column) -> DataFrame:
    """(seconds, minutes) from a start to the last change of the files (modified): whole, and at least one each."""
    passed = F.max("modified").cast("double") - F.max(start).cast("double")
    seconds = F.greatest(F.ceil(passed), F.lit(1)).cast("long")
    return files.agg(seconds.alias("seconds"), F.count(F.lit(1)).alias("n")).filter("n > 0").select("seconds", F.greatest(F.ceil(F.col("seconds") / 60), F.lit(1)).cast("long").alias("minutes"))
