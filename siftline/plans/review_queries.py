"""Queries over documents and labels: groups, routing, pilot, gate, review, publication."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.functions import ids, text
from siftline.functions import lexicons as L
from siftline.operators import assignment, estimate, groups, probe, review
from siftline.plans.registry import query, table


@query("""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '?' ELSE source END AS anchor, CASE WHEN doc_id % 7 = 0 THEN '?' ELSE lang END AS kind FROM documents),
k AS (SELECT doc_id, '{"entry_point":"' || kind || '","group_anchor":"' || anchor || '","harness":"docs","unknown_provenance_artifact":"' || CASE WHEN anchor = '?' AND kind = '?' THEN CAST(doc_id AS VARCHAR) ELSE '?' END || '"}' AS j FROM d)
SELECT 'dependence-' || left(sha256(j), 24) AS group_id, count(*) AS members, min(doc_id) AS representative, array_to_string(list_sort(list(doc_id)), ',') AS packets FROM k GROUP BY j""")
def dependence_groups(spark, sf):
    out = _groups(spark, sf)
    return out.select("group_id", F.size("members").cast("long").alias("members"), "representative", F.array_join(F.col("packets").cast("array<string>"), ",").alias("packets"))


def _groups(spark, sf):
    missing = F.col("doc_id") % 7 == 0
    identity = {"harness": F.lit("docs"), "group_anchor": F.when(~missing, F.col("source")), "entry_point": F.when(~missing, F.col("lang"))}
    return groups.dependence_groups(table(spark, sf, "documents"), identity, "doc_id", "doc_id")


@query("""
WITH g AS (SELECT count(*) AS n FROM documents GROUP BY CASE WHEN doc_id % 7 = 0 THEN CAST(doc_id AS VARCHAR) ELSE source || '/' || lang END)
SELECT count(*) AS groups, count(*) FILTER (n > 1) AS multi_member, max(n) AS max_multiplicity, CAST(sum(n) AS BIGINT) AS members FROM g""")
def dependence_summary(spark, sf):
    n = _groups(spark, sf).select(F.size("members").cast("long").alias("n"))
    return n.agg(F.count(F.lit(1)).alias("groups"), F.count_if(F.col("n") > 1).alias("multi_member"), F.max("n").alias("max_multiplicity"), F.sum("n").alias("members"))


@query("""
WITH g AS (SELECT d.doc_id, CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'marketing_bearing' WHEN l.toxic = 1 THEN 'mixed_work' ELSE 'other' END AS label, CASE WHEN d.lang = 'en' THEN 'mixed' ELSE 'plain' END AS kind
  FROM documents d JOIN labels l USING (doc_id)), n AS (SELECT doc_id, row_number() OVER (ORDER BY sha256('route' || chr(0) || doc_id)) AS k, count(*) OVER () AS total FROM g WHERE label = 'other' AND kind = 'mixed')
SELECT g.doc_id, label, CASE WHEN label <> 'other' THEN 'marketing_bearing' WHEN k <= ceil(total * 0.05) THEN 'mixed_negative_sample' END AS reason,
  CASE WHEN label <> 'other' OR k <= ceil(total * 0.05) THEN 'extraction_pending' ELSE 'group_rolled_up' END AS route FROM g LEFT JOIN n USING (doc_id)""")
def route_groups(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "marketing_bearing").when(F.col("toxic") == 1, "mixed_work").otherwise("other").alias("label"))
    g = table(spark, sf, "documents").select("doc_id", F.when(F.col("lang") == "en", "mixed").otherwise("plain").alias("kind")).join(labels, "doc_id")
    return groups.route(g, "label", "kind", ("marketing_bearing", "mixed_work"), ("mixed", "mixed_work"), "doc_id", "route", 0.05).select("doc_id", "label", "reason", "route")


@query("SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 0 AND d.n_chars > 500")
def eligible_packets(spark, sf):
    return table(spark, sf, "documents").filter("n_chars > 500").select("doc_id", "source").join(table(spark, sf, "labels").filter("toxic = 0").select("doc_id", "quality"), "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_packets(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CAST(coalesce(a, 0) AS BIGINT) AS left_rows, CAST(coalesce(b, 0) AS BIGINT) AS right_rows FROM (SELECT doc_id, count(*) AS a FROM documents GROUP BY 1) d FULL OUTER JOIN (SELECT doc_id, count(*) AS b FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id WHERE coalesce(a, 0) <> 1 OR coalesce(b, 0) <> 1")
def label_coverage(spark, sf):
    gaps = review.coverage_gaps(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")
    return gaps.select("doc_id", F.coalesce("left_rows", F.lit(0)).alias("left_rows"), F.coalesce("right_rows", F.lit(0)).alias("right_rows"))


_STRATA = "CASE WHEN doc_id % 2 = 0 THEN 'claude' ELSE 'codex' END AS harness, CASE WHEN lang = 'en' THEN 'sdk' ELSE 'interactive' END AS execution_kind, CASE WHEN doc_id % 3 = 0 THEN 'child' ELSE 'root' END AS artifact_role, CASE WHEN n_chars > 2000 THEN 'likely_learning' ELSE 'no_learning' END AS learning_expectation, CASE WHEN doc_id % 5 = 0 THEN 'mixed_work' ELSE 'other' END AS workload_class"
_WEIGHTS = ("harness", 16), ("execution_kind", 8), ("artifact_role", 4), ("learning_expectation", 2)


def _strata(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("packet_id"), F.when(F.col("doc_id") % 2 == 0, "claude").otherwise("codex").alias("harness"), F.when(F.col("lang") == "en", "sdk").otherwise("interactive").alias("execution_kind"),
        F.when(F.col("doc_id") % 3 == 0, "child").otherwise("root").alias("artifact_role"), F.when(F.col("n_chars") > 2000, "likely_learning").otherwise("no_learning").alias("learning_expectation"),
        F.when(F.col("doc_id") % 5 == 0, "mixed_work").otherwise("other").alias("workload_class"),
    )


@query(f"SELECT harness, execution_kind, artifact_role, learning_expectation, count(*) AS packets FROM (SELECT doc_id, {_STRATA} FROM documents) GROUP BY 1, 2, 3, 4")
def strata_counts(spark, sf):
    return _strata(spark, sf).groupBy("harness", "execution_kind", "artifact_role", "learning_expectation").agg(F.count(F.lit(1)).alias("packets"))


_LATTICE = "(SELECT unnest(['claude', 'codex', 'other']) AS harness) CROSS JOIN (SELECT unnest(['interactive', 'sdk']) AS execution_kind) CROSS JOIN (SELECT unnest(['root', 'child']) AS artifact_role)"


@query(f"SELECT * FROM {_LATTICE} EXCEPT SELECT harness, execution_kind, artifact_role FROM (SELECT {_STRATA} FROM documents)")
def absent_strata(spark, sf):
    values = [(h, e, r) for h in ("claude", "codex", "other") for e in L.SLOT_EXECUTIONS for r in L.SLOT_ROLES]
    wanted = spark.createDataFrame(values, "harness string, execution_kind string, artifact_role string")
    return wanted.join(_strata(spark, sf), ["harness", "execution_kind", "artifact_role"], "left_anti")


_SLOT_SQL = """
WITH RECURSIVE base AS (SELECT h, e, r, x, row_number() OVER (ORDER BY h, e, ri, xi) AS n FROM (SELECT unnest(['claude', 'codex']) AS h) CROSS JOIN (SELECT unnest(['interactive', 'sdk']) AS e)
  CROSS JOIN (SELECT unnest(['root', 'child']) AS r, unnest([1, 2]) AS ri) CROSS JOIN (SELECT unnest(['likely_learning', 'no_learning']) AS x, unnest([1, 2]) AS xi)),
slots AS (SELECT 'base-' || lpad(CAST(n AS VARCHAR), 2, '0') AS slot_id, h, e, r, x, 'any' AS w FROM base
  UNION ALL SELECT 'mixed-' || lpad(CAST((n + 1) // 2 AS VARCHAR), 2, '0'), h, e, r, CASE WHEN ((n + 1) // 2) % 2 = 1 THEN 'likely_learning' ELSE 'no_learning' END, 'mixed_work' FROM base WHERE n % 2 = 1)
"""


@query(_SLOT_SQL + f""", d AS (SELECT CAST(doc_id AS VARCHAR) AS packet_id, {_STRATA} FROM documents),
m AS (SELECT slot_id, packet_id, CASE WHEN h <> harness THEN 16 ELSE 0 END + CASE WHEN e <> execution_kind THEN 8 ELSE 0 END + CASE WHEN r <> artifact_role THEN 4 ELSE 0 END + CASE WHEN x <> learning_expectation THEN 2 ELSE 0 END
  + CASE WHEN w <> 'any' AND w <> workload_class THEN 1 ELSE 0 END AS distance, row_number() OVER (PARTITION BY slot_id ORDER BY sha256(slot_id || chr(0) || packet_id)) AS k FROM d CROSS JOIN slots)
SELECT slot_id, packet_id, distance, CAST(k AS INTEGER) AS choice_rank, distance * 1000000 + k AS cost FROM m""")
def pilot_cost_matrix(spark, sf):
    return assignment.cost_matrix(assignment.slots(spark), _strata(spark, sf))


@query()
def pilot_assignment(spark, sf):
    """The 24 slots' cheapest assignment; tests hold it against brute force."""
    return assignment.select_pilot(assignment.slots(spark), _strata(spark, sf))


_MADE = "(doc_id % 4 <> 0)"


@query(f"""
WITH p AS (SELECT doc_id, quality = 1 AS expected, toxic = 0 AS clean, {_MADE} AS made, n_chars > 1000 AS useful FROM documents JOIN labels USING (doc_id)),
m AS (SELECT 'data_faithfulness' AS metric, count(*) FILTER (made AND clean) AS numerator, count(*) FILTER (made) AS denominator, 1.0 AS threshold FROM p
 UNION ALL SELECT 'relevance', count(*) FILTER (expected AND made AND useful), count(*) FILTER (expected AND made), 0.8 FROM p
 UNION ALL SELECT 'transferability', count(*) FILTER (expected AND clean AND useful), count(*) FILTER (expected AND clean), 0.7 FROM p
 UNION ALL SELECT 'no_learning_accuracy', count(*) FILTER (expected = made), count(*), 0.8 FROM p UNION ALL SELECT 'novelty', 0, 0, 1.0 FROM (SELECT 1))
SELECT metric, numerator, denominator, CASE WHEN denominator = 0 THEN 1.0 ELSE numerator * CAST(1 AS DOUBLE) / denominator END AS rate, CAST(threshold AS DOUBLE) AS threshold, CASE WHEN denominator = 0 THEN true ELSE numerator * CAST(1 AS DOUBLE) / denominator >= threshold END AS passed FROM m""")
def gate_metrics(spark, sf):
    p = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    expected, clean, made, useful = F.col("quality") == 1, F.col("toxic") == 0, F.col("doc_id") % 4 != 0, F.col("n_chars") > 1000
    pairs = {"data_faithfulness": (made & clean, made), "relevance": (expected & made & useful, expected & made), "transferability": (expected & clean & useful, expected & clean), "no_learning_accuracy": (expected == made, F.lit(True)), "novelty": (F.lit(False), F.lit(False))}
    rows = [review.metric(name, F.count_if(n), F.count_if(d), L.GATE_THRESHOLDS[name]) for name, (n, d) in pairs.items()]
    return p.agg(F.array(*rows).alias("m")).select(F.inline("m"))


_QUEUE = """
WITH c AS (SELECT doc_id, left(text, 40) AS title, text AS content, source AS action, lang AS topic, 'finding' AS learning_type, '[DATA]' AS claim_label, 'session://docs/' || source || '@v' || (doc_id % 3) || '#event=e' || doc_id AS uri FROM documents),
k AS (SELECT *, '{"claim_label":' || to_json(claim_label) || ',"content":' || to_json(content) || ',"title":' || to_json(title) || '}' AS j FROM c)
"""
_IDENTITY = ("title", "content", "claim_label")


def _candidates(spark, sf):
    d = table(spark, sf, "documents")
    uri = ids.evidence_uri(F.lit("docs"), F.col("source"), F.concat(F.lit("v"), (F.col("doc_id") % 3).cast("string")), F.concat(F.lit("e"), F.col("doc_id").cast("string")))
    return d.select(
        "doc_id", F.substring("text", 1, 40).alias("title"), F.col("text").alias("content"), F.col("source").alias("action"), F.col("lang").alias("topic"), F.lit("finding").alias("learning_type"), F.lit("[DATA]").alias("claim_label"),
        F.array(uri).alias("evidence_uris"), F.array(F.col("doc_id").cast("string")).alias("source_candidate_ids"),
    )


@query(_QUEUE + "SELECT arg_min(doc_id, doc_id) AS first_doc, arg_min(action, doc_id) AS action, arg_min(topic, doc_id) AS topic, count(*) AS sources, CAST(count(DISTINCT action) AS INTEGER) AS support_count, array_to_string(list_sort(list(DISTINCT uri)), ' ') AS evidence FROM k GROUP BY title, content, claim_label")
def exact_dedup(spark, sf):
    out = review.exact_dedup(_candidates(spark, sf), "doc_id", _IDENTITY, ("doc_id", "action", "topic"))
    return out.select(F.col("doc_id").alias("first_doc"), "action", "topic", F.size("source_candidate_ids").cast("long").alias("sources"), "support_count", F.array_join("evidence_uris", " ").alias("evidence"))


@query(_QUEUE + "SELECT support_count, count(*) AS candidates FROM (SELECT CAST(count(DISTINCT action) AS INTEGER) AS support_count FROM k GROUP BY title, content, claim_label) GROUP BY support_count")
def support_count(spark, sf):
    return review.exact_dedup(_candidates(spark, sf), "doc_id", _IDENTITY).groupBy("support_count").agg(F.count(F.lit(1)).alias("candidates"))


@query("""
WITH x AS (SELECT a.doc_id AS retained, a.doc_id + 1 AS collapsed, a.text AS t FROM documents a)
SELECT retained, collapsed, b.doc_id IS NULL OR b.text <> t AS false_collapse FROM x LEFT JOIN documents b ON b.doc_id = collapsed""")
def false_dedup(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    claims = d.select(F.col("doc_id").alias("retained"), (F.col("doc_id") + 1).alias("collapsed"), F.col("text").alias("kept"))
    joined = claims.join(d.select(F.col("doc_id").alias("collapsed"), "text"), "collapsed", "left")
    return joined.select("retained", "collapsed", (~F.coalesce(F.col("kept") == F.col("text"), F.lit(False))).alias("false_collapse"))


_DECIDED = """
WITH c AS (SELECT d.doc_id, source, lang, n_chars, CASE WHEN l.quality = 0 THEN 'reject' WHEN l.toxic = 1 THEN 'edit' ELSE 'accept' END AS decision FROM documents d JOIN labels l USING (doc_id))
"""


def _decided(spark, sf):
    c = table(spark, sf, "documents").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("candidate_id"), "doc_id", F.col("doc_id").cast("string").alias("title"), F.col("source").alias("content"), F.lit("use").alias("action"), F.col("lang").alias("topic"),
        F.lit("finding").alias("learning_type"), F.lit("[DATA]").alias("claim_label"), F.lit(1).alias("support_count"),
    )
    said = table(spark, sf, "labels").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("candidate_id"), F.when(F.col("quality") == 0, "reject").when(F.col("toxic") == 1, "edit").otherwise("accept").alias("decision"),
        F.lit(None).cast("string").alias("title"), F.lit("[edited]").alias("content"), F.lit(None).cast("string").alias("action"), F.lit("seo").alias("topic"), F.lit(None).cast("string").alias("learning_type"),
    )
    return c, said


@query(_DECIDED + """, p AS (SELECT 'c' || doc_id AS candidate_id, decision, CAST(doc_id AS VARCHAR) AS title, CASE decision WHEN 'edit' THEN '[edited]' ELSE source END AS content, 'use' AS action,
  CASE decision WHEN 'edit' THEN 'seo' ELSE lang END AS topic, 'finding' AS learning_type, '[DATA]' AS claim_label, 1 AS support_count FROM c WHERE decision <> 'reject')
SELECT 'learning-' || left(sha256(candidate_id || chr(0) || '{"action":"' || action || '","claim_label":"[DATA]","content":"' || content || '","learning_type":"finding","support_count":"1","title":"' || title || '","topic":"' || topic || '"}'), 24) AS learning_id, * FROM p""")
def decisions_publish(spark, sf):
    return review.publish(*_decided(spark, sf))


@query(_DECIDED + "SELECT count(*) FILTER (decision = 'accept') AS accept, count(*) FILTER (decision = 'edit') AS edit, count(*) FILTER (decision = 'reject') AS reject FROM c")
def decision_counts(spark, sf):
    _, said = _decided(spark, sf)
    joined = said.join(table(spark, sf, "documents").select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("candidate_id")), "candidate_id")
    return joined.agg(*(F.count_if(F.col("decision") == d).alias(d) for d in ("accept", "edit", "reject")))


@query(_QUEUE + "SELECT count(*) AS learnings, CAST(sum(n) AS BIGINT) AS sources, max(n) AS widest FROM (SELECT count(*) AS n FROM (SELECT * FROM k WHERE doc_id % 2 = 0 UNION ALL SELECT * FROM k WHERE doc_id % 2 = 1) GROUP BY title, content, claim_label)")
def consolidate(spark, sf):
    c = _candidates(spark, sf)
    both = c.filter("doc_id % 2 = 0").unionByName(c.filter("doc_id % 2 = 1"))
    out = review.exact_dedup(both, "doc_id", _IDENTITY).select(F.size("source_candidate_ids").cast("long").alias("n"))
    return out.agg(F.count(F.lit(1)).alias("learnings"), F.sum("n").alias("sources"), F.max("n").alias("widest"))


@query(_DECIDED + "SELECT doc_id, source AS content, 'pending' AS review_status FROM c WHERE decision <> 'accept'")
def requeue(spark, sf):
    c, said = _decided(spark, sf)
    return c.join(said.filter("decision <> 'accept'").select("candidate_id"), "candidate_id", "left_semi").select("doc_id", "content", F.lit("pending").alias("review_status"))


@query("""
WITH n AS (SELECT count(DISTINCT text) AS g FROM documents), f AS (SELECT g, CAST(ceil(g * 0.1) AS BIGINT) AS full_groups, CAST(ceil(g * 0.05) AS BIGINT) AS mixed_groups FROM n),
s AS (SELECT *, least(g, full_groups + mixed_groups) AS stage_groups FROM f), c AS (SELECT *, (g + 92) // 93 AS small_calls, (stage_groups + 8) // 9 AS large_calls FROM s),
b AS (SELECT *, small_calls + large_calls AS calls, (g * 1024 + stage_groups * 10240 + 2) // 3 + (small_calls + large_calls) * 800 AS base FROM c)
SELECT g AS groups, full_groups, mixed_groups, stage_groups, CAST(93 AS BIGINT) AS small_per_call, CAST(9 AS BIGINT) AS large_per_call, small_calls, large_calls, base + CAST(ceil(base * 0.2) AS BIGINT) AS input_tokens, calls * 5000 AS output_tokens, calls,
  (calls + 1) // 2 * 20 AS wall_minutes, CASE WHEN base + CAST(ceil(base * 0.2) AS BIGINT) > 5000000 THEN 'input_tokens' WHEN calls > 300 THEN 'calls' WHEN (calls + 1) // 2 * 20 > 360 THEN 'wall_minutes' END AS breach FROM b""")
def tiered_estimate(spark, sf):
    row = table(spark, sf, "documents").agg(F.countDistinct("text").alias("g"))
    costs = estimate.tiered(F.col("g"))
    return row.select(*(c.alias(n) for n, c in costs.items()), estimate.first_breach(costs, L.FULL_LIMITS).alias("breach"))


@query(f"SELECT doc_id, list_sort(list_filter([CASE WHEN n_chars < 300 THEN 'summary:too_short' END, CASE WHEN lang NOT IN ('en', 'fr') THEN 'topic:unsupported' END, CASE WHEN source = 'src0' THEN 'claim_label:unsupported' END], lambda x: x IS NOT NULL)) AS errors FROM documents")
def candidate_errors(spark, sf):
    checks = [(F.col("n_chars") < 300, "summary:too_short"), (~F.col("lang").isin("en", "fr"), "topic:unsupported"), (F.col("source") == "src0", "claim_label:unsupported")]
    return table(spark, sf, "documents").select("doc_id", review.error_list(checks).alias("errors"))


@query(f"""
WITH t AS (SELECT doc_id, regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9_]+') AS w FROM documents), s AS (SELECT doc_id, list_distinct(w) AS t FROM t)
SELECT doc_id, len(t) >= 8 AND len(list_intersect(t, ['the', 'les', 'der'])) > 0 AND len(list_intersect(t, ['that', 'dans', 'ist'])) > 0 AS relevant,
  len(t) >= 12 AND len(list_intersect(t, ['when', 'if', 'because'])) > 0 AND len(list_intersect(t, ['that', 'dans', 'ist'])) > 0 AND len(list_intersect(t, ['the', 'les', 'der'])) > 0 AS transferable,
  len(list_intersect(t, ['with', 'mit'])) > 0 AND len(list_intersect(t, ['the', 'les', 'der'])) = 0 AS harness_only FROM s""")
def candidate_flags(spark, sf):
    m, d, h = ("the", "les", "der"), ("that", "dans", "ist"), ("with", "mit")
    c = F.col("text")
    return table(spark, sf, "documents").select("doc_id", review.relevant(F.lit(True), c, c, m, d).alias("relevant"), review.transferable(c, m, d).alias("transferable"), review.harness_only(text.tokens(c), h, m).alias("harness_only"))


@query("""
WITH a AS (SELECT 'u' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS artifact_id, CASE WHEN user_id % 3 = 0 THEN 'child' ELSE 'root' END AS source_kind, CASE WHEN user_id % 5 = 0 THEN 'p' END AS parent, count(*) FILTER (event_type = 'purchase') AS marketing_events, count(*) AS events FROM events GROUP BY user_id)
SELECT artifact_id, marketing_events, events FROM a WHERE source_kind = 'root' AND parent IS NULL ORDER BY marketing_events DESC, events DESC, artifact_id LIMIT 8""")
def probe_selection(spark, sf):
    u = F.col("user_id")
    e = table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("marketing_events"), F.count(F.lit(1)).alias("events"))
    a = e.select(F.concat(F.lit("u"), F.lpad(u.cast("string"), 6, "0")).alias("artifact_id"), F.when(u % 3 == 0, "child").otherwise("root").alias("source_kind"), F.when(u % 5 == 0, "p").alias("parent_artifact_id"), "marketing_events", "events")
    return probe.select_roots(a, least=1).select("artifact_id", "marketing_events", "events")


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 'reasoned' WHEN event_type = 'error' THEN NULL WHEN event_id % 6 = 0 THEN 'observed' ELSE 'asserted' END AS strength FROM events""")
def record_strength(spark, sf):
    """Events as session records: a user's is observed only where every part is a tool result with its id (event_id % 6 = 0)."""
    k, kind = F.col("event_id") % 6, F.when(F.col("event_type") == "view", "assistant").when(F.col("event_type") == "error", "system").otherwise("user")
    good = F.lit('{"type":"tool_result","tool_use_id":"t"}')
    parts = F.when(k == 0, F.concat(good, F.lit(","), good)).when(k == 1, "").when(k == 2, F.concat(good, F.lit(',{"type":"text"}'))).when(k == 3, F.lit('{"type":"tool_result","tool_use_id":" "}')).when(k == 4, F.lit('{"type":"tool_result","tool_use_id":5}')).otherwise(good)
    rest = F.when(k == 5, "}").otherwise(',"toolUseResult":{}}')
    body = F.concat(F.lit('{"type":"'), kind, F.lit('","message":{"role":"user","content":['), parts, F.lit("]}"), rest)
    return table(spark, sf, "events").select("event_id", probe.record_strength(body).alias("strength"))


@query("SELECT source, doc_id, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 4 AS INTEGER) AS batch, sha256(left(text, 2400)) AS shown FROM documents")
def call_batches(spark, sf):
    """Four documents to a call, each text as far as a probe shows it."""
    d = table(spark, sf, "documents").select("source", "doc_id", F.sha2(F.substring("text", 1, probe.SHOWN), 256).alias("shown"))
    return probe.call_batches(d, ["source"], ["doc_id"])


@query("""
WITH s AS (SELECT l_returnflag, sum(l_orderkey) AS b, count(*) AS n FROM lineitem GROUP BY l_returnflag),
e AS (SELECT (b + 2) // 3 + n * 800 AS base, n, b, CASE l_returnflag WHEN 'A' THEN 4 ELSE 2 END AS concurrency, CASE l_returnflag WHEN 'A' THEN 7 ELSE 20 END AS minutes FROM s)
SELECT CAST(sum(base + ceil(base * 0.2)) AS BIGINT) AS input_tokens, CAST(sum(n * 5000) AS BIGINT) AS output_tokens, CAST(sum(n) AS BIGINT) AS calls, CAST(sum(((n + 1) // 2) * 20) AS BIGINT) AS wall_minutes, CAST(sum(b) AS BIGINT) AS packet_bytes, min(concurrency) AS concurrency, max(minutes) AS per_call_minutes FROM e""")
def combined_estimate(spark, sf):
    s = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.sum("l_orderkey").alias("packet_bytes"), F.count(F.lit(1)).alias("n"))
    costs = estimate.call_costs(F.col("packet_bytes"), F.col("n"))
    first = F.col("l_returnflag") == "A"
    stages = s.select("packet_bytes", *(c.alias(n) for n, c in costs.items()), F.when(first, 4).otherwise(2).alias("concurrency"), F.when(first, 7).otherwise(20).alias("per_call_minutes"))
    return estimate.combined(stages)


@query("SELECT o_orderstatus, coalesce(o_orderpriority, 'unknown') AS o_orderpriority, count(*) AS outcomes FROM orders GROUP BY 1, 2")
def terminal_counts(spark, sf):
    return review.terminal_counts(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query("SELECT 'candidate_document_validity' AS metric, count(*) AS invalid_packets, false AS passed FROM labels WHERE quality = 0 HAVING count(*) > 0")
def validity_metric(spark, sf):
    return review.validity_metric(table(spark, sf, "labels").select(F.when(F.col("quality") == 0, "rejected_invalid").otherwise("extracted").alias("terminal_status")))
