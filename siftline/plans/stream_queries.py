"""Streams run to their end over a table, and sessions read from JSON lines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from siftline.functions import blocks
from siftline.functions import lexicons as L
from siftline.operators import normalize, sessions
from siftline.plans.registry import query, table
from siftline.sources import jsonl, scratch
from siftline.streaming import windows


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_window_counts(spark, sf):
    """Hourly counts by type: the last state of every window, those still open too."""
    events = windows.stream_table(spark, f"{sf}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "event_id")
    out, path = windows.windowed_counts(events, "ts", "event_type", "1 hour", "1 hour"), scratch.folder(spark, "stream")
    windows.run_updates(out, f"{path}/out", f"{path}/state")
    done = windows.latest(spark, f"{path}/out", ["start", "event_type"], out.schema)
    return done.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT event_id, any_value(user_id) AS user_id FROM events GROUP BY event_id")
def stream_dedup(spark, sf):
    events = windows.stream_table(spark, f"{sf}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "user_id")
    out, path = windows.deduplicated(events, "ts", "event_id", "1 hour"), scratch.folder(spark, "stream")
    windows.run_available(out, f"{path}/out", f"{path}/state")
    return spark.read.schema(out.schema).parquet(f"{path}/out").select("event_id", "user_id")


@query("""
WITH f AS (SELECT user_id, event_type, row_number() OVER w AS n, lag(event_type) OVER w AS was FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
e AS (SELECT *, event_type <> 'error' OR coalesce(was, '') = 'error' AS done FROM f), s AS (SELECT user_id, min(n) FILTER (done) AS stop FROM e GROUP BY user_id)
SELECT CAST(e.user_id AS VARCHAR) AS item, CAST(n AS INTEGER) AS attempt, event_type AS outcome, done AS terminal FROM e JOIN s USING (user_id) WHERE stop IS NULL OR n <= stop""")
def stream_attempt_ledger(spark, sf):
    events = windows.stream_table(spark, f"{sf}/events.parquet").select("event_id", "user_id", "event_type")
    out, path = windows.attempt_ledger(events, "user_id", "event_id", "event_type", "error"), scratch.folder(spark, "stream")
    windows.run_available(out, f"{path}/out", f"{path}/state")
    return spark.read.schema(out.schema).parquet(f"{path}/out")


def _at(text):
    return F.lit(text).cast("timestamp")


def _lines(spark, sf):
    """Conversations as lines of a session source, a minute a turn, in all the ways that records differ.

    By conv_id % 6: conflicting parents, a child, conflicting ids, a second id, late ids, a sidechain;
    by conv_id % 5 the third line has a time that is none, or no time.
    """
    c = table(spark, sf, "conversations")
    k, t, conv = F.col("conv_id") % 6, F.col("turn"), F.col("conv_id").cast("string")
    odd = F.when(t == 2, F.col("conv_id") % 5)
    stamp = F.when(odd == 0, "1700000000").when(odd == 1, F.lit(None)).otherwise(F.concat(F.lit("2024-01-01T00:0"), t.cast("string"), F.lit(":00Z")))
    own = F.when((k == 2) & (t == 1), F.concat(F.lit("other"), conv)).when((k == 4) & (t >= 4), "late").otherwise(F.concat(F.lit("s"), conv))
    body = F.to_json(F.struct(
        F.col("role").alias("type"), stamp.alias("timestamp"), own.alias("sessionId"), F.when(k == 3, F.concat(F.lit("x"), conv)).alias("session_id"),
        F.when(k == 1, F.concat(F.lit("s"), (F.col("conv_id") - 1).cast("string"))).alias("parentUuid"), F.when(k == 0, F.concat(F.lit("p"), (t % 2).cast("string"))).alias("parent_uuid"),
        F.when(k == 4, "sdk-ts").when(k == 5, "cli").alias("entrypoint"), F.when(k == 4, False).when(k == 5, True).alias("isSidechain"), F.when(k == 5, "/a/tests/b").when(k == 0, "/x/documents/y").alias("cwd"),
        F.struct(F.col("role").alias("role"), F.col("text").alias("content")).alias("message"),
    ))
    path = F.concat(F.lit("/root/chat/"), conv, F.lit(".jsonl"))
    lines = c.select(F.lit("claude").alias("harness"), path.alias("path"), t.cast("long").alias("line_no"), body.alias("raw"), F.octet_length(body).cast("long").alias("bytes"))
    rows = sessions.records(jsonl.parse_lines(lines), {"claude": "/root/chat"}, _at("2024-01-01T00:01:00Z"), _at("2024-01-01T00:04:00Z"))
    return scratch.stored(rows, scratch.folder(spark, "lines"))


def _dependence(harness: str, entry: str, container: str, parent: str, directory: str) -> str:
    """SQL of a dependence group's id."""
    anchor = f"CASE WHEN {container} <> '?' THEN {container} ELSE {parent} END"
    fields = {"code_version": "'?'", "configuration_version": "'?'", "entry_point": entry, "group_anchor": anchor, "harness": f"'{harness}'", "injected_context_fingerprint": "'?'", "input_hash": "'?'", "parent_reference": parent, "prompt_hash": "'?'", "session_container_id": container, "session_kind": "'?'", "source_dataset": "'?'", "working_directory_category": directory}
    inner = " || ',' || ".join(f"'\"{k}\":\"' || {v} || '\"'" for k, v in fields.items())
    return f"'dependence-' || left(sha256('{{' || {inner} || '}}'), 24)"


_CLAUDE = """
WITH r AS (SELECT conv_id, turn AS t, role, text, conv_id % 6 AS k, conv_id % 5 AS m, turn < 4 AND NOT (turn = 2 AND conv_id % 5 < 2) AS early,
  CASE WHEN conv_id % 6 = 2 AND turn = 1 THEN 'other' || conv_id WHEN conv_id % 6 = 4 AND turn >= 4 THEN 'late' ELSE 's' || conv_id END AS sid FROM conversations),
j AS (SELECT *, '{' || array_to_string(list_filter([CASE k WHEN 5 THEN '"cwd":"/a/tests/b"' WHEN 0 THEN '"cwd":"/x/documents/y"' END, CASE k WHEN 4 THEN '"entrypoint":"sdk-ts"' WHEN 5 THEN '"entrypoint":"cli"' END,
  CASE k WHEN 4 THEN '"isSidechain":false' WHEN 5 THEN '"isSidechain":true' END, '"message":{"content":' || to_json(text) || ',"role":"' || role || '"}', CASE WHEN k = 1 THEN '"parentUuid":"s' || (conv_id - 1) || '"' END,
  CASE WHEN k = 0 THEN '"parent_uuid":"p' || (t % 2) || '"' END, '"sessionId":"' || sid || '"', CASE WHEN k = 3 THEN '"session_id":"x' || conv_id || '"' END, '"timestamp":"2024-01-01T00:0' || t || ':00Z"', '"type":"' || role || '"'], lambda x: x IS NOT NULL), ',') || '}' || chr(10) AS line FROM r),
a AS (SELECT conv_id, k, 'artifact-' || left(sha256('claude' || chr(0) || conv_id || '.jsonl'), 24) AS artifact_id, count(*) AS total_lines, count(*) AS parsed_lines, count(*) FILTER (t = 2 AND m = 1) AS missing_timestamps,
  count(*) FILTER (t = 2 AND m = 0) AS invalid_timestamps, count(*) FILTER (early AND t >= 1) AS events, CAST(coalesce(sum(octet_length(encode(line))) FILTER (early AND t >= 1), 0) AS BIGINT) AS canonical_bytes,
  coalesce(sha256(string_agg(line, '' ORDER BY t) FILTER (early AND t >= 1)), '?') AS content_sha256, count(DISTINCT sid) FILTER (early) AS n_ids, min(sid) FILTER (early) AS one_id, count(*) FILTER (early) AS n_early,
  count(*) FILTER (t >= 4 AND k = 4) AS n_late, count(DISTINCT t % 2) FILTER (early) AS n_parents, min(t % 2) FILTER (early) AS a_parent FROM j GROUP BY conv_id, k),
b AS (SELECT *, CASE WHEN n_ids = 1 THEN one_id ELSE '?' END AS session_id, n_ids > 1 AS conflicting_ids, CAST(CASE WHEN k = 3 AND n_early > 0 THEN 1 ELSE 0 END AS INTEGER) AS supplemental_ids,
  CAST(CASE WHEN n_ids = 1 THEN n_late ELSE 0 END AS BIGINT) AS post_cutoff_conflicts, CASE WHEN n_early = 0 THEN '?' WHEN k = 1 THEN 's' || (conv_id - 1) WHEN k = 0 AND n_parents = 1 THEN 'p' || a_parent ELSE '?' END AS parent_ref,
  CASE WHEN n_early = 0 THEN '?' WHEN k = 4 THEN 'sdk-ts' WHEN k = 5 THEN 'cli' ELSE '?' END AS entry, CASE WHEN n_early = 0 THEN 'unknown' WHEN k = 5 THEN 'synthetic_test' WHEN k = 0 THEN 'documents' ELSE 'unknown' END AS directory FROM a)
"""


@query(_CLAUDE + f"""
SELECT b.artifact_id, b.total_lines, b.parsed_lines, b.missing_timestamps, b.invalid_timestamps, b.events, b.canonical_bytes, b.content_sha256, b.session_id, b.session_id AS container_id, b.conflicting_ids, b.session_id = '?' AS missing_session_id, b.supplemental_ids,
  b.post_cutoff_conflicts, b.parent_ref, p.artifact_id AS parent_id, b.entry, b.directory, CASE WHEN b.entry = 'sdk-ts' THEN 'sdk' WHEN b.entry = 'cli' THEN 'interactive' ELSE 'unknown' END AS shape,
  CASE WHEN b.parent_ref <> '?' OR (b.k = 5 AND b.n_early > 0) THEN 'child_agent' WHEN b.k = 4 AND b.n_early > 0 THEN 'root_conversation' ELSE 'unknown' END AS source_kind,
  CASE WHEN b.events > 0 THEN 'complete' ELSE 'excluded' END AS status, CASE WHEN b.events = 0 THEN 'no_in_window_events' END AS reason, {_dependence("claude", "b.entry", "b.session_id", "b.parent_ref", "b.directory")} AS dependence_group_id
FROM b LEFT JOIN b p ON b.parent_ref = p.session_id AND p.session_id <> '?'""")
def session_census(spark, sf):
    """Every column of the census of conversations as session records (no session id occurs twice)."""
    out = sessions.artifact_census(_lines(spark, sf))
    return out.select("artifact_id", "total_lines", "parsed_lines", "missing_timestamps", "invalid_timestamps", "events", "canonical_bytes", "content_sha256", "session_id", "container_id", "conflicting_ids", "missing_session_id", "supplemental_ids",
                      "post_cutoff_conflicts", "parent_ref", "parent_id", "entry", "directory", "shape", "source_kind", "status", "reason", "dependence_group_id")


@query("""
WITH r AS (SELECT user_id AS u, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events),
x AS (SELECT *, ts < TIMESTAMP '2024-01-22 12:00:00' AS early, ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 12:00:00' AS inside,
  (n = 0 AND u % 4 <> 2) AS own_meta, (n = 2 AND u % 4 = 1) AS old_meta FROM r),
a AS (SELECT u, count(*) AS total_lines, count(*) FILTER (inside) AS events, count(*) FILTER (event_type = 'error' AND NOT own_meta AND NOT old_meta) AS unknown_types, bool_or(own_meta AND early) AS has_own, bool_or(old_meta AND early) AS has_old,
  bool_or(old_meta AND NOT early) AS late_old, bool_or(early AND NOT own_meta AND NOT old_meta) AS has_other FROM x GROUP BY u),
b AS (SELECT *, CASE WHEN has_own THEN 't' || u WHEN has_old THEN 't' || (u - 1) WHEN has_other THEN 'c' || u ELSE '?' END AS session_id, CASE WHEN has_own OR (has_other AND NOT has_old) THEN 'c' || u WHEN has_old THEN 'c' || (u - 1) ELSE '?' END AS container_id,
  CASE WHEN has_own AND u % 4 = 3 THEN 't' || (u - 1) ELSE '?' END AS parent_ref FROM a)
SELECT 'artifact-' || left(sha256('codex' || chr(0) || 'u' || u || '.jsonl'), 24) AS artifact_id, total_lines, events, unknown_types, session_id, container_id, parent_ref, session_id = '?' AS missing_session_id, CAST(CASE WHEN has_own AND has_old THEN 2 ELSE 0 END AS INTEGER) AS supplemental_ids,
  CAST(CASE WHEN has_own AND late_old THEN 1 ELSE 0 END AS BIGINT) AS post_cutoff_conflicts, CASE WHEN has_own THEN 'interactive' ELSE 'unknown' END AS shape, CASE WHEN parent_ref <> '?' THEN 'child_agent' ELSE 'unknown' END AS source_kind, CASE WHEN events > 0 THEN 'complete' ELSE 'excluded' END AS status FROM b""")
def codex_census(spark, sf):
    """Events as records of one artifact a user: own and retained session metadata, children, unknown types, ids after the cutoff."""
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    e = table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), n.alias("n"))
    u, name = F.col("user_id"), lambda p, d=0: F.concat(F.lit(p), (F.col("user_id") - d).cast("string"))
    own, old = (F.col("n") == 0) & (u % 4 != 2), (F.col("n") == 2) & (u % 4 == 1)
    payload = F.struct(
        F.when(own, name("t")).when(old, name("t", 1)).alias("id"), F.when(old, name("c", 1)).otherwise(name("c")).alias("session_id"), F.when(own & (u % 4 == 3), name("t", 1)).when(old, "zzz").alias("parent_thread_id"), F.when(own, "cli").when(old, "other").alias("source"),
    )
    kind = F.when(own | old, "session_meta").when(F.col("event_type") == "error", "weird").otherwise("response_item")
    body = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"), kind.alias("type"), payload.alias("payload")))
    lines = e.select(F.lit("codex").alias("harness"), F.concat(F.lit("/root/codex/u"), u.cast("string"), F.lit(".jsonl")).alias("path"), F.col("n").cast("long").alias("line_no"), body.alias("raw"), F.octet_length(body).cast("long").alias("bytes"))
    rows = sessions.records(jsonl.parse_lines(lines), {"codex": "/root/codex"}, _at("2024-01-08T00:00:00Z"), _at("2024-01-22T12:00:00Z"))
    out = sessions.artifact_census(scratch.stored(rows, scratch.folder(spark, "lines")))
    return out.select("artifact_id", "total_lines", "events", "unknown_types", "session_id", "container_id", "parent_ref", "missing_session_id", "supplemental_ids", "post_cutoff_conflicts", "shape", "source_kind", "status")


@query("""
SELECT 'artifact-' || left(sha256('claude' || chr(0) || conv_id || '.jsonl'), 24) AS artifact_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS ordinal, role,
  CASE role WHEN 'user' THEN 'asserted' ELSE 'reasoned' END AS strength, sha256(text) AS text_sha256 FROM conversations
  WHERE turn BETWEEN 1 AND 3 AND NOT (turn = 2 AND conv_id % 5 < 2) AND role IN ('user', 'assistant', 'system')""")
def session_events(spark, sf):
    return sessions.normalized_events(_lines(spark, sf)).select("artifact_id", "ordinal", "role", "strength", F.sha2("text", 256).alias("text_sha256"))


_KNOWN_BLOCK = "<<B>>known<<E>>"
_SPOILT = """
WITH c AS (SELECT conv_id, conv_id % 10 AS k, count(*) FILTER (trim(text) <> '') AS n, min(turn) FILTER (role = 'system' AND trim(text) <> '') AS sys, bool_or(turn = 1) AS has FROM conversations GROUP BY conv_id),
o AS (SELECT *, 'artifact-' || left(sha256('claude' || chr(0) || conv_id || '.jsonl'), 24) AS artifact_id, CASE WHEN k = 9 THEN 'source_manifest_resolution_failed' WHEN k = 8 THEN 'malformed_jsonl' WHEN k = 7 THEN 'manifest_source_mismatch'
  WHEN sys < 1 THEN 'unknown_injected_context' WHEN has AND k = 2 THEN 'unknown_injected_context' WHEN has AND k = 3 THEN 'unresolved_injected_context' WHEN sys = 1 THEN 'unknown_injected_context'
  WHEN has AND k = 4 THEN 'credential_detected' WHEN has AND k = 5 THEN 'event_too_large' WHEN sys IS NOT NULL THEN 'unknown_injected_context' WHEN has AND k = 6 THEN 'packet_too_large' END AS reason FROM c)
"""


def _normalized(spark, sf):
    """Conversations as session records, spoilt in their second turn or their manifest by conv_id % 10."""
    c = table(spark, sf, "conversations")
    k, conv, second = F.col("conv_id") % 10, F.col("conv_id").cast("string"), F.col("turn") == 1
    spoil = F.when(k == 1, _KNOWN_BLOCK).when(k == 2, "<<B>>changed<<E>>").when(k == 3, "<<B>>open").when(k == 4, " AKIA" + "ABCDEFGHIJKLMNOP").when(k == 5, F.repeat(F.lit("x y "), 70_000)).when(k == 6, F.repeat(F.lit("x y "), 30_000)).otherwise("")
    said = F.concat("text", F.when(second, spoil).otherwise(""))
    stamp = F.concat(F.lit("2024-01-01T00:0"), F.col("turn").cast("string"), F.lit(":00Z"))
    body = F.to_json(F.struct(F.col("role").alias("type"), stamp.alias("timestamp"), F.concat(F.lit("s"), conv).alias("sessionId"), F.when(F.col("role") == "system", said).alias("content"), F.when(F.col("role") != "system", F.struct(F.col("role").alias("role"), said.alias("content"))).alias("message")))
    lines = c.select(F.lit("claude").alias("harness"), F.concat(F.lit("/root/chat/"), conv, F.lit(".jsonl")).alias("path"), F.col("turn").cast("long").alias("line_no"), body.alias("raw"), F.octet_length(body).cast("long").alias("bytes"))
    base = scratch.folder(spark, "normalize")
    rows = scratch.stored(sessions.records(jsonl.parse_lines(lines), {"claude": "/root/chat"}, _at("2024-01-01T00:00:00Z"), _at("2024-01-02T00:00:00Z")), f"{base}/rows")
    kind = c.select(sessions.artifact_key(F.lit("claude"), F.concat(F.lit("/root/chat/"), conv, F.lit(".jsonl")), {"claude": "/root/chat"}).alias("artifact_id"), k.alias("k")).distinct()
    manifest = sessions.artifact_census(rows).select("artifact_id", "harness", "status", "reason", "events", "content_sha256").join(kind, "artifact_id")
    status, reason = F.when(F.col("k") == 8, "quarantined").otherwise(F.col("status")), F.when(F.col("k") == 8, "malformed_jsonl").otherwise(F.col("reason"))
    manifest = manifest.select("artifact_id", "harness", status.alias("status"), reason.alias("reason"), F.when(F.col("k") == 7, F.col("events") + 1).otherwise(F.col("events")).alias("events"), "content_sha256")
    manifest = scratch.stored(manifest, f"{base}/manifest")
    there = rows.join(kind.filter("k <> 9").select("artifact_id"), "artifact_id", "left_semi")  # what is left of the source when it is read again
    return normalize.normalize(there, manifest, [blocks.Rule("<<B>>", "<<E>>", frozenset([blocks.fingerprint(_KNOWN_BLOCK)]), frozenset(["claude:user", "claude:assistant"]))])


@query(_SPOILT + """
SELECT artifact_id, CASE WHEN reason IS NULL THEN 'complete' ELSE 'quarantined' END AS status, reason, CASE WHEN reason IS NULL THEN n ELSE 0 END AS events, CAST(CASE WHEN k = 1 AND has AND sys IS NULL THEN 1 ELSE 0 END AS BIGINT) AS excluded_blocks FROM o""")
def normalization_outcomes(spark, sf):
    return _normalized(spark, sf).outcomes.select("artifact_id", "status", "reason", "events", "excluded_blocks")


@query(_SPOILT + """
, t AS (SELECT o.*, v.turn, row_number() OVER (PARTITION BY v.conv_id ORDER BY v.turn) AS ordinal FROM o JOIN conversations v USING (conv_id) WHERE k < 7),
f AS (SELECT *, CASE WHEN reason IN ('packet_too_large') OR reason IS NULL THEN NULL WHEN sys IS NOT NULL AND sys <= 1 THEN sys ELSE 1 END AS stop FROM t)
SELECT artifact_id, CAST(ordinal AS INTEGER) AS ordinal, CASE WHEN turn = stop THEN 'quarantined' ELSE 'packet' END AS disposition, CASE WHEN turn = stop THEN reason ELSE '?' END AS reason FROM f WHERE stop IS NULL OR turn <= stop""")
def normalization_coverage(spark, sf):
    return _normalized(spark, sf).coverage.select("artifact_id", "ordinal", "disposition", "reason")


@query(_SPOILT + """
SELECT count(*) AS artifacts, count(*) FILTER (reason IS NULL) AS complete, CAST(0 AS BIGINT) AS excluded, count(*) FILTER (reason IS NOT NULL) AS quarantined, CAST(0 AS BIGINT) AS failed, CAST(coalesce(sum(n) FILTER (reason IS NULL), 0) AS BIGINT) AS events,
  count(*) FILTER (k = 1 AND has AND sys IS NULL) AS injected_excluded_blocks, CAST(max(CASE WHEN k = 1 AND has AND sys IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS injected_fingerprints FROM o""")
def normalization_summary(spark, sf):
    return normalize.summary(_normalized(spark, sf)).select("artifacts", *L.TERMINAL_STATUSES, "events", "injected_excluded_blocks", "injected_fingerprints")


@query(_SPOILT + "SELECT artifact_id, true AS whole FROM o WHERE reason IS NULL")
def normalization_proof(spark, sf):
    """Every event of a complete artifact is in one packet, and told once."""
    return normalize.covered(_normalized(spark, sf))
