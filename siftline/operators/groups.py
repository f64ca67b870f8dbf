"""Dependence groups, representatives, hash samples and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions import ids


def first_known(*cols: Column) -> Column:
    """The first that is neither null, blank nor the unknown mark; else the mark."""
    return F.coalesce(*(F.nullif(F.nullif(F.trim(c.cast("string")), F.lit("")), F.lit(ids.UNKNOWN)) for c in cols), F.lit(ids.UNKNOWN))


def dependence_groups(rows: DataFrame, identity: dict[str, Column], member: str, packet: str) -> DataFrame:
    """group_id, members, packets (sorted, distinct) and the representative: the smallest packet.

    A row without any known identity field is a group of its own.
    """
    usable = F.lit(False)
    for name, col in identity.items():
        if name != "harness":
            usable = usable | (ids.known(col) != ids.UNKNOWN)
    own = F.when(usable, F.lit(ids.UNKNOWN)).otherwise(F.col(member).cast("string"))
    group = ids.canonical_id("dependence-", **identity, unknown_provenance_artifact=own)
    return rows.withColumn("group_id", group).groupBy("group_id").agg(
        F.array_sort(F.collect_set(member)).alias("members"), F.array_sort(F.collect_set(packet)).alias("packets"), F.min(packet).alias("representative")
    )


def hash_ranks(rows: DataFrame, choice: str, strata: list[str]) -> DataFrame:
    """rows with rank (1 is the smallest hash) and n, the size of the stratum.

    Ranks come from counts by leading digits plus a rank within these, so that
    a stratum spreads over thousands of windows and none is sorted in one task.
    """
    keys = strata or ["_all"]
    rows = rows if strata else rows.withColumn("_all", F.lit(1))
    rows = rows.withColumn("_digits", F.substring(choice, 1, 3))
    counts = rows.groupBy(*keys, "_digits").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    running = whole.orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keys)), F.col("_digits").alias("_d"), F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("n"))
    same = F.col("_digits") == F.col("_d")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
    within = F.row_number().over(Window.partitionBy(*keys, "_digits").orderBy(choice))
    ranked = rows.withColumn("_rank", within).join(counts, same)
    drop = ["_digits", "_d", "_before", "_rank", *(f"_{i}" for i in range(len(keys))), *([] if strata else ["_all"])]
    return ranked.withColumn("rank", (F.col("_before") + F.col("_rank")).cast("long")).drop(*drop)


def hash_sample(rows: DataFrame, key: str, salt: str, share: float, strata: list[str] | None = None) -> DataFrame:
    """The ceil(n * share) rows with the smallest salted hashes (of each stratum).

    The order comes from the hash alone, so reruns and other partitionings agree.
    """
    chosen = F.sha2(F.concat(F.lit(salt), F.lit("\0"), F.col(key).cast("string")), 256)
    ranked = hash_ranks(rows.withColumn("choice", chosen), "choice", strata or [])
    return ranked.filter(F.col("rank") <= F.ceil(F.col("n") * share)).drop("n")


def route(groups: DataFrame, label: str, kind: str, positives: tuple[str, ...], sampled_kinds: tuple[str, ...], key: str, salt: str, share: float) -> DataFrame:
    """groups with route and reason: positives and a hash sample of the mixed negatives go on."""
    positive = F.col(label).isin(*positives)
    negatives = groups.filter(~F.coalesce(positive, F.lit(False)) & F.col(kind).isin(*sampled_kinds))
    picked = hash_sample(negatives, key, salt, share).select(F.col(key).alias("_key"), F.lit(True).alias("_picked"))
    joined = groups.join(picked, F.col(key) == F.col("_key"), "left")
    reason = F.when(positive, "marketing_bearing").when(F.col("_picked"), "mixed_negative_sample")
    return joined.withColumn("reason", reason).withColumn("route", F.when(F.col("reason").isNotNull(), "extraction_pending").otherwise("group_rolled_up")).drop("_key", "_picked")
