"""Queries over conversations as artifacts: events, packets, coverage, evidence."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from siftline.functions import ids, text
from siftline.functions import lexicons as L
from siftline.operators import packing, review
from siftline.plans.registry import query, table

LIMIT, OVERFLOW_LIMIT = 2400, 1200


def _bytes():
    return F.octet_length("text")


@query("""
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS ordinal,
  CASE role WHEN 'user' THEN 'asserted' WHEN 'assistant' THEN 'reasoned' WHEN 'tool_result' THEN 'observed' ELSE NULL END AS strength, role NOT IN ('user', 'assistant') AND trim(text) <> '' AS quarantined FROM conversations""")
def event_strength(spark, sf):
    role = F.col("role")
    strength = F.when(role == "user", "asserted").when(role == "assistant", "reasoned").when(role == "tool_result", "observed")
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    return table(spark, sf, "conversations").select("conv_id", "turn", n.alias("ordinal"), strength.alias("strength"), (~role.isin("user", "assistant") & (F.trim("text") != "")).alias("quarantined"))


@query("""
SELECT conv_id, min(turn) AS at_turn, arg_min(reason, turn) AS reason FROM (
  SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'instruction_role' WHEN octet_length(encode(text)) > 1200 THEN 'event_too_large' END AS reason FROM conversations)
WHERE reason IS NOT NULL GROUP BY conv_id""")
def earliest_quarantine(spark, sf):
    reason = F.when(F.col("role") == "system", "instruction_role").when(_bytes() > OVERFLOW_LIMIT, "event_too_large")
    bad = table(spark, sf, "conversations").select("conv_id", "turn", reason.alias("reason")).filter("reason is not null")
    return bad.groupBy("conv_id").agg(F.min("turn").alias("at_turn"), F.min_by("reason", "turn").alias("reason"))


def _greedy_sql(limit: int) -> str:
    return f"""
WITH RECURSIVE r AS (SELECT conv_id, turn, octet_length(encode(text)) AS b, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
p AS (SELECT conv_id, turn, b, n, 1 AS packet, CAST(b AS BIGINT) AS used FROM r WHERE n = 1
  UNION ALL SELECT r.conv_id, r.turn, r.b, r.n, CASE WHEN p.used > 0 AND p.used + r.b > {limit} THEN p.packet + 1 ELSE p.packet END,
    CASE WHEN p.used > 0 AND p.used + r.b > {limit} THEN r.b ELSE p.used + r.b END FROM p JOIN r ON r.conv_id = p.conv_id AND r.n = p.n + 1)
"""


@query(_greedy_sql(LIMIT) + f"SELECT conv_id, turn, CAST(b AS BIGINT) AS size, packet, b > {LIMIT} AS overflow FROM p")
def packets_greedy(spark, sf):
    return packing.greedy(table(spark, sf, "conversations"), ["conv_id"], ["turn"], _bytes(), LIMIT)


@query(_greedy_sql(OVERFLOW_LIMIT) + """
SELECT conv_id, count(*) AS events, max(packet) AS packets, CASE WHEN max(b) > 1200 THEN 'quarantined' ELSE 'prepared' END AS outcome FROM p GROUP BY conv_id""")
def packet_outcomes(spark, sf):
    packed = packing.greedy(table(spark, sf, "conversations"), ["conv_id"], ["turn"], _bytes(), OVERFLOW_LIMIT)
    return packed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("events"), F.max("packet").alias("packets"), F.when(F.bool_or("overflow"), "quarantined").otherwise("prepared").alias("outcome"))


@query(_greedy_sql(LIMIT) + """
, c AS (SELECT conv_id, packet, min(turn) AS first_turn, count(*) AS n_events, sum(b) AS bytes FROM p GROUP BY conv_id, packet)
SELECT conv_id, packet AS part, count(*) OVER (PARTITION BY conv_id) AS parts, n_events, CAST(bytes AS BIGINT) AS bytes, (CAST(bytes AS BIGINT) + 2) // 3 AS tokens FROM c""")
def split_packets(spark, sf):
    packed = packing.greedy(table(spark, sf, "conversations"), ["conv_id"], ["turn"], _bytes(), LIMIT)
    by = packed.groupBy("conv_id", "packet").agg(F.count(F.lit(1)).alias("n_events"), F.sum("size").alias("bytes"))
    parts = F.count(F.lit(1)).over(Window.partitionBy("conv_id"))
    return by.select("conv_id", F.col("packet").alias("part"), parts.alias("parts"), "n_events", "bytes", F.floor((F.col("bytes") + 2) / 3).cast("long").alias("tokens"))


@query("""
WITH RECURSIVE r AS (SELECT lang, doc_id, octet_length(encode(text)) AS b, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents),
p AS (SELECT lang, doc_id, b, n, 1 AS packet, CAST(b AS BIGINT) AS used FROM r WHERE n = 1
  UNION ALL SELECT r.lang, r.doc_id, r.b, r.n, CASE WHEN p.used > 0 AND p.used + r.b > 96000 THEN p.packet + 1 ELSE p.packet END,
    CASE WHEN p.used > 0 AND p.used + r.b > 96000 THEN r.b ELSE p.used + r.b END FROM p JOIN r ON r.lang = p.lang AND r.n = p.n + 1)
SELECT lang, packet AS batch, count(*) AS items, CAST(sum(b) AS BIGINT) AS bytes, 'batch-' || left(sha256(lang || chr(0) || string_agg(doc_id, ',' ORDER BY doc_id)), 24) AS batch_id FROM p GROUP BY lang, packet""")
def batches_per_harness(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "doc_id", _bytes().alias("bytes"))
    packed = packing.greedy(docs, ["lang"], ["doc_id"], F.col("bytes"), 96_000)
    by = packed.groupBy("lang", F.col("packet").alias("batch")).agg(F.count(F.lit(1)).alias("items"), F.sum("size").alias("bytes"), F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return by.select("lang", "batch", "items", "bytes", ids.stable_id("batch-", F.col("lang"), F.array_join(F.col("ids").cast("array<string>"), ",")).alias("batch_id"))


@query(_greedy_sql(LIMIT) + """
, packs AS (SELECT conv_id, packet, list(turn ORDER BY turn) AS turns FROM p GROUP BY conv_id, packet),
joined AS (SELECT conv_id, flatten(list(turns ORDER BY packet)) AS covered, count(*) AS packets FROM packs GROUP BY conv_id),
src AS (SELECT conv_id, list(turn ORDER BY turn) AS turns FROM conversations GROUP BY conv_id)
SELECT src.conv_id, packets, covered = turns AS ordered, len(list_distinct(covered)) = len(covered) AS once FROM src JOIN joined USING (conv_id)""")
def coverage_proof(spark, sf):
    turns = table(spark, sf, "conversations")
    packed = packing.greedy(turns, ["conv_id"], ["turn"], _bytes(), LIMIT)
    packs = packed.groupBy("conv_id", "packet").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    joined = packs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("packet", "turns"))).alias("p"), F.count(F.lit(1)).alias("packets"))
    covered = joined.select("conv_id", "packets", F.flatten(F.transform("p", lambda x: x["turns"])).alias("covered"))
    source = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return source.join(covered, "conv_id").select("conv_id", "packets", (F.col("covered") == F.col("turns")).alias("ordered"), (F.size(F.array_distinct("covered")) == F.size("covered")).alias("once"))


@query("""
SELECT conv_id, turn, CAST(running AS BIGINT) AS running_bytes FROM (
  SELECT conv_id, turn, sum(octet_length(encode(text))) OVER (PARTITION BY conv_id ORDER BY turn) AS running FROM conversations) WHERE running <= 4096""")
def compact_prefix(spark, sf):
    fits = packing.prefix_that_fits(table(spark, sf, "conversations").select("conv_id", "turn", "text"), ["conv_id"], ["turn"], _bytes(), 4096)
    return fits.select("conv_id", "turn", "running_bytes")


_URI = "'session://chat/c' || conv_id || '@' || left(sha256(role), 8) || '#event=t' || turn"


def _uri():
    return ids.evidence_uri(F.lit("chat"), F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.substring(F.sha2("role", 256), 1, 8), F.concat(F.lit("t"), F.col("turn").cast("string")))


@query(f"""
WITH u AS (SELECT {_URI} AS uri FROM conversations)
SELECT uri, regexp_extract(uri, '^session://([a-z0-9_-]+)/', 1) AS harness, regexp_extract(uri, '/([a-z0-9_-]+)@', 1) AS artifact, regexp_extract(uri, '#event=(.+)$', 1) AS event FROM u""")
def evidence_uris(spark, sf):
    rows = table(spark, sf, "conversations").select(_uri().alias("uri"))
    parts = ids.parse_uri(F.col("uri"))
    return rows.select("uri", parts["harness"].alias("harness"), parts["artifact"].alias("artifact"), parts["event"].alias("event"))


@query("""
SELECT conv_id, turn FROM conversations c WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT conv_id AS k, turn + 1 AS t FROM conversations WHERE role = 'user') e WHERE e.k = c.conv_id AND e.t = c.turn)""")
def pointer_resolvable(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    sample = rows.filter("role = 'user'").select(F.col("conv_id"), (F.col("turn") + 1).alias("turn"))
    return rows.select("conv_id", "turn").join(sample, ["conv_id", "turn"], "left_semi")


@query("""
SELECT event_type, user_id % 10 AS pointer, CASE WHEN count(DISTINCT CASE WHEN value > 50 THEN 'observed' ELSE 'asserted' END) = 1 THEN min(CASE WHEN value > 50 THEN 'observed' ELSE 'asserted' END) ELSE 'unknown' END AS strength
FROM events GROUP BY event_type, user_id % 10""")
def evidence_index(spark, sf):
    rows = table(spark, sf, "events").select(F.struct("event_type", (F.col("user_id") % 10).alias("pointer")).alias("p"), F.when(F.col("value") > 50, "observed").otherwise("asserted").alias("s"))
    return review.evidence_index(rows, "p", "s").select("p.event_type", "p.pointer", "strength")


@query("""
WITH cited AS (SELECT conv_id, turn, unnest([turn - 1, turn, turn + 3]) AS cites, unnest([0, 1, 2]) AS i FROM conversations WHERE role = 'assistant'),
j AS (SELECT c.conv_id, c.turn, i, t.role AS role FROM cited c LEFT JOIN conversations t ON t.conv_id = c.conv_id AND t.turn = c.cites)
SELECT conv_id, turn, list_sort(list_distinct(list(CASE WHEN role IS NULL THEN 'candidate.evidence_uris[' || i || ']:not_in_packet' WHEN role <> 'user' THEN 'candidate.evidence_uris[' || i || ']:not_observed' END)
  FILTER (role IS NULL OR role <> 'user'))) AS errors FROM j GROUP BY conv_id, turn""")
def evidence_validation(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    cited = rows.filter("role = 'assistant'").select("conv_id", "turn", F.posexplode(F.array(F.col("turn") - 1, F.col("turn"), F.col("turn") + 3)).alias("i", "cites"))
    found = cited.join(rows.select(F.col("conv_id"), F.col("turn").alias("cites"), "role"), ["conv_id", "cites"], "left")
    code = lambda what: F.concat(F.lit("candidate.evidence_uris["), F.col("i").cast("string"), F.lit(f"]:{what}"))
    error = F.when(F.col("role").isNull(), code("not_in_packet")).when(F.col("role") != "user", code("not_observed"))
    return found.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_set(error)).alias("errors"))


@query("SELECT conv_id, turn, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS fingerprint FROM conversations")
def turn_fingerprints(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.fingerprint(F.col("text")).alias("fingerprint"))


@query("""
WITH u AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'session://claude/artifact-' || left(sha256(text), 24) || '@' || sha256(role) || '#event=event-' || left(sha256(text), 24) WHEN 1 THEN 'session://codex/a b@' || sha256(role) || '#event=x' WHEN 2 THEN 'session://chat/c' || conv_id || '@v1#event=t' || turn ELSE 'session:/' || conv_id END AS uri FROM conversations)
SELECT conv_id, turn, """ + ", ".join(f"regexp_matches(uri, '{p}') AS {n}" for n, p in L.EVIDENCE_GRAMMARS.items()) + " FROM u")
def evidence_grammars(spark, sf):
    """Which of the three grammars each URI follows."""
    t, text_hash, role_hash, conv = F.col("turn"), F.substring(F.sha2("text", 256), 1, 24), F.sha2("role", 256), F.col("conv_id").cast("string")
    whole = F.concat(F.lit("session://claude/artifact-"), text_hash, F.lit("@"), role_hash, F.lit("#event=event-"), text_hash)
    uri = F.when(t % 4 == 0, whole).when(t % 4 == 1, F.concat(F.lit("session://codex/a b@"), role_hash, F.lit("#event=x"))).when(t % 4 == 2, F.concat(F.lit("session://chat/c"), conv, F.lit("@v1#event=t"), t.cast("string"))).otherwise(F.concat(F.lit("session:/"), conv))
    return table(spark, sf, "conversations").select("conv_id", "turn", *(ids.well_formed(uri, n).alias(n) for n in L.EVIDENCE_GRAMMARS))


@query("""
WITH RECURSIVE r AS (SELECT lang, doc_id, octet_length(encode(left(text, 2000))) + 1 AS b, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents),
p AS (SELECT lang, doc_id, b, n, 1 AS batch, CAST(b AS BIGINT) AS used FROM r WHERE n = 1
  UNION ALL SELECT r.lang, r.doc_id, r.b, r.n, CASE WHEN p.used + r.b > 61984 THEN p.batch + 1 ELSE p.batch END, CASE WHEN p.used + r.b > 61984 THEN r.b ELSE p.used + r.b END FROM p JOIN r ON r.lang = p.lang AND r.n = p.n + 1)
SELECT lang, doc_id, batch FROM p""")
def reserved_batches(spark, sf):
    """Batches of 64,000 bytes by language, 2,000 of them kept for prompt and calibration."""
    d = table(spark, sf, "documents").select("lang", "doc_id", F.substring("text", 1, 2000).alias("payload"))
    return packing.reserved_batches(d, "lang", ["doc_id"], "payload", 64_000, 2_000).select("lang", "doc_id", "batch")
