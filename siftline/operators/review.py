"""Review: exact dedup, evidence checks, decisions, publication, gate metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions import ids, text
from siftline.functions import lexicons as L

IDENTITY = ("title", "content", "action", "topic", "learning_type", "claim_label")
EDITABLE = ("title", "content", "action", "topic", "learning_type")


def candidate_id(fields: tuple[str, ...] = IDENTITY) -> Column:
    return ids.canonical_id("candidate-", **{f: F.col(f) for f in fields})


def artifact_support(uris: Column) -> Column:
    """Distinct artifacts among evidence URIs: what stands before the version."""
    return F.size(F.array_distinct(F.transform(uris, lambda u: F.substring_index(u, "@", 1))))


def exact_dedup(rows: DataFrame, order: str, fields: tuple[str, ...] = IDENTITY, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row an identity: evidence and sources are united, all else comes from the first row by order."""
    merged = rows.withColumn("candidate_id", candidate_id(fields)).groupBy("candidate_id").agg(
        *(F.min_by(f, order).alias(f) for f in (*fields, *keep)),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("evidence_uris")))).alias("evidence_uris"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("source_candidate_ids")))).alias("source_candidate_ids"),
    )
    return merged.withColumn("support_count", artifact_support(F.col("evidence_uris")))


def coverage_gaps(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of either side without a partner, or with a key that repeats; empty means covered."""
    left = a.groupBy(key).agg(F.count(F.lit(1)).alias("left_rows"))
    right = b.groupBy(key).agg(F.count(F.lit(1)).alias("right_rows"))
    both = left.join(right, key, "full_outer")
    return both.filter((F.coalesce("left_rows", F.lit(0)) != 1) | (F.coalesce("right_rows", F.lit(0)) != 1))


def publish(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Accepted and edited candidates as learnings: edits replace fields, ids stay, nothing is merged anew."""
    joined = candidates.join(decisions.select("candidate_id", "decision", *(F.col(f).alias(f"edit_{f}") for f in EDITABLE)), "candidate_id").filter("decision <> 'reject'")
    for f in EDITABLE:
        joined = joined.withColumn(f, F.when(F.col("decision") == "edit", F.coalesce(f"edit_{f}", f)).otherwise(F.col(f)))
    body = ids.canonical(**{f: F.col(f) for f in IDENTITY}, support_count=F.col("support_count"))
    learning = F.concat(F.lit("learning-"), F.substring(F.sha2(F.concat(F.col("candidate_id"), F.lit("\0"), body), 256), 1, 24))
    return joined.select(learning.alias("learning_id"), "candidate_id", "decision", *IDENTITY, "support_count")


def metric(name: str, numerator: Column, denominator: Column, threshold: float) -> Column:
    """A gate row: a ratio of nothing counts as one."""
    rate = F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(1.0))
    return F.struct(F.lit(name).alias("metric"), numerator.cast("long").alias("numerator"), denominator.cast("long").alias("denominator"), rate.alias("rate"), F.lit(threshold).alias("threshold"), (rate >= threshold).alias("passed"))


def validity_metric(outcomes: DataFrame) -> DataFrame:
    """The gate's extra metric: packets of which the document was rejected as invalid; no row if there are none."""
    bad = F.count_if(F.col("terminal_status") == "rejected_invalid")
    return outcomes.agg(F.lit("candidate_document_validity").alias("metric"), bad.alias("invalid_packets"), F.lit(False).alias("passed")).filter("invalid_packets > 0")


def terminal_counts(outcomes: DataFrame, *by: str) -> DataFrame:
    """How many outcomes there are of each status, provider or both."""
    return outcomes.groupBy(*(F.coalesce(c, F.lit("unknown")).alias(c) for c in by)).agg(F.count(F.lit(1)).alias("outcomes"))


def relevant(topic_approved: Column, summary: Column, rationale: Column, marketing=L.PILOT_MARKETING, decision=L.PILOT_DECISION, least: int = 8) -> Column:
    both = F.array_union(text.tokens(summary), text.tokens(rationale))
    return topic_approved & (F.size(text.tokens(summary)) >= least) & (text.shared(both, marketing) > 0) & (text.shared(both, decision) > 0)


def transferable(rationale: Column, marketing=L.PILOT_MARKETING, decision=L.PILOT_DECISION, least: int = 12) -> Column:
    t = text.tokens(rationale)
    return (F.size(t) >= least) & (text.shared(t, ("when", "if", "because")) > 0) & (text.shared(t, decision) > 0) & (text.shared(t, marketing) > 0)


def harness_only(tokens_: Column, harness=L.LESSON_HARNESS, marketing=L.LESSON_MARKETING) -> Column:
    return (text.shared(tokens_, harness) > 0) & (text.shared(tokens_, marketing) == 0)


def first_reason(checks: list[tuple[Column, str | Column]], accepted: str = "accepted") -> Column:
    """The reason of the first check that holds, in order."""
    out = None
    for test, reason in checks:
        value = F.lit(reason) if isinstance(reason, str) else reason
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(accepted)


def error_list(checks: list[tuple[Column, str]]) -> Column:
    """Sorted distinct error codes of the checks that hold."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(test, code) for test, code in checks)))))


def evidence_index(rows: DataFrame, pointer: str, strength: str) -> DataFrame:
    """pointer, strength: conflicting strengths make it unknown, for good."""
    return rows.groupBy(pointer).agg(F.when(F.count_distinct(F.col(strength)) == 1, F.min(strength)).otherwise("unknown").alias("strength"))
