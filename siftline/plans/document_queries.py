"""Queries over packets, candidate documents, releases and attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.functions import ids
from siftline.operators import documents, packets, provider
from siftline.plans.registry import query, table


def _events(spark, sf):
    c = table(spark, sf, "conversations")
    artifact = F.concat(F.lit("c"), F.col("conv_id").cast("string"))
    strength = F.when(F.col("role") == "user", "asserted").otherwise("reasoned")
    return c.select(artifact.alias("artifact_id"), F.lit("chat").alias("harness"), F.col("turn").cast("int").alias("ordinal"), F.lit(1).alias("part"), "role", strength.alias("strength"), "text", ids.stable_id("event-", artifact, F.col("turn"), F.col("role")).alias("event_id"))


@query("""
SELECT 'c' || conv_id AS artifact_id, count(*) AS events, CASE WHEN bool_or(role = 'system' AND trim(text) <> '') THEN 'quarantined' ELSE 'prepared_no_egress' END AS status,
  CASE WHEN bool_or(role = 'system' AND trim(text) <> '') THEN 'instruction_role_content' END AS reason FROM conversations GROUP BY conv_id""")
def artifact_outcomes(spark, sf):
    return packets.artifact_outcomes(packets.checked_events(_events(spark, sf))).select("artifact_id", "events", "status", "reason")


@query()
def redacted_packets(spark, sf):
    """Packets of safe conversations after redaction; tests hold order, size and coverage."""
    return packets.build_packets(packets.checked_events(_events(spark, sf)), max_bytes=8192).select("packet_id", "artifact_id", F.size("event_ids").alias("n_events"), "bytes", "tokens")


@query()
def compact_packets(spark, sf):
    """The prefix of each packet that fits 4096 bytes (tested)."""
    built = packets.build_packets(packets.checked_events(_events(spark, sf)))
    return packets.compact(built).select("packet_id", F.size("event_ids").alias("n_events"))


@query("""
SELECT 'c' || conv_id || '-' || turn AS event, CASE WHEN bool_or(role = 'system' AND trim(text) <> '') OVER (PARTITION BY conv_id) THEN 'quarantined' ELSE 'packet' END AS disposition FROM conversations""")
def event_dispositions(spark, sf):
    e = _events(spark, sf)
    checked = packets.checked_events(e)
    cover = packets.event_coverage(checked, packets.build_packets(checked))
    return e.join(cover.select("event_id", "disposition"), "event_id").select(F.concat("artifact_id", F.lit("-"), F.col("ordinal").cast("string")).alias("event"), "disposition")


@query("""
WITH d AS (SELECT doc_id, lang, source, n_chars FROM documents)
SELECT 'p' || doc_id AS packet_id, list_sort(list_filter([CASE WHEN lang = 'es' THEN 'candidate[0].topic:unsupported' END, 'candidate[0].candidate_id:not_stable', CASE WHEN doc_id % 3 = 0 THEN 'candidate.evidence_uris[0]:not_observed' END,
  CASE WHEN doc_id % 3 = 1 THEN 'candidate.evidence_uris[0]:not_in_packet' END], lambda x: x IS NOT NULL)) AS errors, 'rejected_invalid' AS terminal_status FROM d""")
def candidate_documents(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    packet = F.concat(F.lit("p"), F.col("doc_id").cast("string"))
    uri = F.when(F.col("doc_id") % 3 == 1, "elsewhere").otherwise("u")
    cand = F.struct(
        F.lit("made-up").alias("candidate_id"), F.when(F.col("lang") == "es", "fishing").otherwise("seo").alias("topic"), F.lit("finding").alias("learning_type"), F.lit("[DATA]").alias("claim_label"), F.lit("s").alias("summary"),
        F.lit("t").alias("title"), F.lit("r").alias("recommended_action"), F.lit("w").alias("transferability_rationale"), F.array(uri).alias("evidence_uris"),
    )
    docs = d.select(packet.alias("packet_id"), F.lit("candidates").alias("result_type"), F.lit(None).cast("string").alias("no_learning_reason"), F.array(cand).cast(f"array<{documents.CANDIDATE}>").alias("candidates"))
    known = d.select(packet.alias("packet_id"), F.create_map(F.lit("u"), F.when(F.col("doc_id") % 3 == 0, "asserted").otherwise("observed")).alias("strengths"))
    return documents.validate(docs, known).select("packet_id", "errors", "terminal_status")


@query("""
WITH f AS (SELECT user_id, event_id, event_type, row_number() OVER w AS n, lag(event_type) OVER w AS was FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
e AS (SELECT *, event_type IS NOT DISTINCT FROM was AS again FROM f), s AS (SELECT user_id, min(n) FILTER (again) AS stop FROM e GROUP BY user_id)
SELECT e.user_id, CAST(n AS INTEGER) AS attempt_number, event_type AS failure_code, CASE WHEN again THEN 'failed' ELSE 'retrying' END AS status FROM e JOIN s USING (user_id) WHERE stop IS NULL OR n <= stop""")
def provider_attempts(spark, sf):
    return provider.attempts(table(spark, sf, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id", "event_type").select("user_id", "attempt_number", "failure_code", "status")


@query("""
SELECT l_orderkey, l_linenumber, CAST(round((CAST(l_partkey AS DECIMAL(18,0)) * 3 + CAST(l_suppkey AS DECIMAL(18,0)) * 15) / 1000000.0, 6) AS DOUBLE) AS cost FROM lineitem""")
def provider_cost(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", provider.cost(F.col("l_partkey"), F.col("l_suppkey"), "3", "15").cast("double").alias("cost"))


@query("SELECT doc_id % 10 AS topic, left(text, 180) AS title, left(text, 700) AS content, source AS recommended_action, lang AS learning_type FROM documents")
def calibration_examples(spark, sf):
    d = table(spark, sf, "documents").select(F.col("text").alias("title"), F.col("text").alias("content"), F.col("source").alias("action"), (F.col("doc_id") % 10).alias("topic"), F.col("lang").alias("learning_type"))
    return provider.calibration_examples(d)


@query("""
SELECT user_id % 4 AS kind, CAST(sum(CASE WHEN event_id % 3 = 0 AND event_id < 100 THEN NULL ELSE event_id % 1000 + coalesce(CASE WHEN event_id % 3 <> 0 THEN event_id % 7 END, 0) END) AS BIGINT) AS tokens FROM events GROUP BY user_id % 4""")
def provider_usage(spark, sf):
    i = F.col("event_id")
    used = provider.total_input_tokens(i % 1000, F.when(i % 3 != 0, i % 7), F.lit(None).cast("long"))
    rows = table(spark, sf, "events").select((F.col("user_id") % 4).alias("kind"), F.when((i % 3 == 0) & (i < 100), F.lit(None)).otherwise(F.coalesce(used, i % 1000)).alias("t"))
    return rows.groupBy("kind").agg(F.sum("t").alias("tokens"))
