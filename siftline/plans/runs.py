"""Whole runs: the value probe, the quality pilot's verdict, the full corpus.

Each is driver control over small aggregates; what it reads and makes are
DataFrames.  A gate that does not hold ends the run with a status and reason
instead of a partial result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.functions import lexicons as L
from siftline.functions import text
from siftline.operators import estimate, groups, packing, probe, provider, review

CANDIDATE = "id string, title string, content string, label string, topic string, type string, decision string, evidence array<string>"


@dataclass
class Receipt:
    status: str
    reason: str
    accepted: int = 0
    decisions: DataFrame | None = None
    dimension: str | None = None


def affine(release: dict) -> bool:
    """Whether a release goes to the harness's own provider and account."""
    return (release.get("provider"), release.get("account")) == {"claude": ("anthropic", "authenticated-claude"), "codex": ("openai", "authenticated-codex")}.get(release.get("harness"))


def decide(candidates: DataFrame, baseline: DataFrame, pointers: DataFrame | None, marketing=L.PROBE_MARKETING, harness=L.PROBE_HARNESS) -> DataFrame:
    """id, reason of each candidate: the first check that fails, or accepted.

    pointers is (pointer, strength) of the sample's packets; without it nothing
    is resolved, and no claim from data can be accepted.
    """
    blind = pointers is None
    if blind:
        pointers = candidates.sparkSession.createDataFrame([], "pointer string, strength string")
    rows = candidates.withColumn("tokens", text.semantic_tokens(F.concat_ws(" ", "content", "decision"))).withColumn("own", text.semantic_tokens(F.col("content")))
    fresh = probe.novelty(rows.select("id", F.col("own").alias("tokens")), baseline.select("id", text.semantic_tokens(F.col("text")).alias("tokens")), "id")
    cited = rows.select("id", F.explode_outer("evidence").alias("pointer")).join(pointers, "pointer", "left").groupBy("id").agg(
        F.bool_and(F.coalesce(F.regexp_like("pointer", F.lit(r"^session://[a-z0-9_-]+/[a-z0-9_-]+@[A-Za-z0-9._-]+#event=[A-Za-z0-9._-]+$")), F.lit(False))).alias("formed"),
        F.bool_and(F.col("strength").isNotNull()).alias("resolved"), F.bool_or(F.coalesce(F.col("strength") == "observed", F.lit(False))).alias("observed"),
    )
    all_ = rows.join(fresh, "id").join(cited, "id")
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    missing = empty("title") | empty("content") | empty("label") | empty("topic") | empty("type") | empty("decision") | (F.coalesce(F.size("evidence"), F.lit(0)) < 1)
    body = F.concat_ws("\n", "title", "content", "topic", "type", "decision")
    unsafe = (F.size(text.credential_ids(body)) > 0) | text.has_markup(body)
    own = text.shared(F.col("tokens"), marketing)
    checks = [
        (unsafe, "unsafe_candidate"), (missing, "missing_required_field"), (~F.col("label").isin(*L.CLAIM_LABELS), "invalid_claim_label"), (~F.col("formed"), "invalid_evidence"), (~F.col("resolved") & F.lit(not blind), "unresolvable_evidence"),
        ((text.shared(F.col("tokens"), harness) > 0) & (own == 0), "harness_only"), (own == 0, "not_marketing"), (F.trim("decision") == "", "no_marketing_decision"), (F.col("outcome") != "novel", F.col("outcome")),
        ((F.col("label") == "[DATA]") & F.lit(blind), "data_evidence_strength_unavailable"), ((F.col("label") == "[DATA]") & ~F.col("observed"), "data_evidence_not_observed"),
    ]
    return all_.select("id", review.first_reason(checks).alias("reason"))


def value_probe(sample: DataFrame, packets: DataFrame, baseline: DataFrame, release: dict, dispatch, limits: dict[str, int] = L.PROBE_LIMITS, least: int = 8, most: int = 12) -> Receipt:
    """Gates in order: sample size, affinity, quarantine, budget, call, accepted candidates.

    sample (artifact_id), packets (artifact_id, status, bytes, pointer, strength: a row an event);
    dispatch takes packets and gives candidates (CANDIDATE).
    """
    if not least <= sample.limit(most + 1).count() <= most:
        return Receipt("blocked", "invalid_sample_size")
    if not affine(release):
        return Receipt("blocked", "provider_affinity_mismatch")
    if packets.filter(F.lower("status") == "quarantined").limit(1).count():
        return Receipt("reduced_scope", "redaction_quarantine")
    calls = int(release.get("calls", 1))
    costs = estimate.call_costs(F.coalesce(F.sum("bytes"), F.lit(0)), F.lit(calls))
    try:
        estimate.enforce(packets.agg(*(c.alias(n) for n, c in costs.items())), limits)
    except estimate.BudgetExceeded as e:
        return Receipt("reduced_scope", "resource_envelope_exceeded", dimension=e.dimension)
    try:
        candidates = dispatch(packets)
    except RuntimeError:
        return Receipt("blocked", "provider_call_failed")
    decisions = decide(candidates, baseline, review.evidence_index(packets, "pointer", "strength"))
    accepted = decisions.filter("reason = 'accepted'").count()
    return Receipt("passed" if accepted >= least else "reduced_scope", "r23_passed" if accepted >= least else "r23_threshold_not_met", accepted, decisions)


def pilot_verdict(metrics: DataFrame, outcomes: DataFrame, wanted: int = 24, false_collapses: int = 0) -> Receipt:
    """The gate over all metric rows, once each wanted packet has one terminal outcome."""
    seen = outcomes.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("packet_id").alias("d")).first()
    if seen.n != wanted or seen.d != wanted:
        return Receipt("blocked", "outcomes_incomplete")
    failed = [r.metric for r in metrics.filter(~F.col("passed")).orderBy("metric").collect()]  # a handful of metrics
    if false_collapses:
        failed.append("false_dedup")
    return Receipt("failed", ",".join(failed)) if failed else Receipt("passed", "all_gates_passed")


def batched(items: DataFrame, limit: int = 96_000) -> DataFrame:
    """items (harness, work_item_id, payload) with batch_id: greedy by bytes within a harness."""
    placed = packing.greedy(items.withColumn("n", F.octet_length("payload")), ["harness"], ["work_item_id"], F.col("n"), limit, ["payload"])
    return placed.select(F.concat_ws("-", F.lit("batch"), "harness", F.col("packet").cast("string")).alias("batch_id"), "harness", "work_item_id", "payload")


def full_corpus(group_rows: DataFrame, classify: provider.Runner, extract: provider.Runner, share: float = 0.05, salt: str = "full") -> dict[str, DataFrame]:
    """Classify every group, route, extract what goes on: the tables of a run.

    group_rows is (group_id, harness, session_kind, payload).  Results must
    cover their items exactly, else the run raises.
    """
    items = group_rows.select("harness", F.col("group_id").alias("work_item_id"), "payload")
    labels = provider.run_batches(batched(items), classify)
    labelled = group_rows.join(labels.filter("status = 'complete'").select(F.col("work_item_id").alias("group_id"), F.col("result").alias("label")), "group_id")
    if review.coverage_gaps(group_rows, labelled, "group_id").limit(1).count():
        raise RuntimeError("classification does not cover the groups")
    routed = groups.route(labelled, "label", "session_kind", ("marketing_bearing", "mixed_work"), ("mixed_work", "mixed"), "group_id", salt, share)
    chosen = routed.filter("route = 'extraction_pending'").select("harness", F.col("group_id").alias("work_item_id"), "payload")
    extracted = provider.run_batches(batched(chosen), extract)
    if review.coverage_gaps(chosen, extracted, "work_item_id").limit(1).count():
        raise RuntimeError("extraction does not cover its items")
    return {"labels": labels, "routed": routed, "extracted": extracted}
