"""Census queries over events, conversations and the star tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from siftline.functions import ids
from siftline.functions import lexicons as L
from siftline.operators import census
from siftline.plans.registry import query, strings, table

START, CUTOFF = "2024-01-08 00:00:00", "2024-01-22 12:00:00"
_WINDOW = f"ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{CUTOFF}'"
_KINDS = ("click", "view", "purchase")


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _inside():
    return census.in_window(F.col("ts"), _at(START), _at(CUTOFF))


@query(f"""
SELECT user_id, count(*) AS events, sum(octet_length(encode(props))) AS canonical_bytes, min(ts) AS first_ts, max(ts) AS last_ts,
  count(DISTINCT event_type) AS kinds
FROM events WHERE {_WINDOW} GROUP BY user_id""")
def census_window_counts(spark, sf):
    e = table(spark, sf, "events").filter(census.window_filter(F.col("ts"), _at(START), _at(CUTOFF)))
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.sum(F.octet_length("props")).alias("canonical_bytes"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.countDistinct("event_type").alias("kinds"))


@query(f"""
SELECT count(*) AS total, count(*) FILTER ({_WINDOW}) AS half_open, count(*) FILTER (ts BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{CUTOFF}') AS closed,
  count(*) FILTER (ts < TIMESTAMP '{CUTOFF}') AS before_cutoff, count(*) FILTER (ts >= TIMESTAMP '{CUTOFF}') AS late FROM events""")
def census_window_variants(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(_inside()).alias("half_open"), F.count_if(census.in_closed_window(ts, _at(START), _at(CUTOFF))).alias("closed"),
        F.count_if(ts < _at(CUTOFF)).alias("before_cutoff"), F.count_if(ts >= _at(CUTOFF)).alias("late"),
    )


def _statuses(spark, sf):
    """Users as artifacts: errors count as malformed lines, very large values as oversized records."""
    by = table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(_inside()).alias("n"), F.count_if((F.col("event_type") == "error") & _inside()).alias("bad"), F.count_if(F.col("value") > 900).alias("big")
    )
    status, reason = census.terminal_status(F.col("user_id") % 37 == 0, F.col("user_id") % 41 == 0, F.col("big"), F.when(F.col("bad") > F.col("n") / 3, F.col("bad")).otherwise(0), F.col("n"))
    return by.select("user_id", F.col("n").alias("events"), status.alias("status"), reason.alias("reason"))


_STATUS = f"""
WITH u AS (SELECT user_id, count(*) FILTER ({_WINDOW}) AS n, count(*) FILTER (event_type = 'error' AND {_WINDOW}) AS bad, count(*) FILTER (value > 900) AS big FROM events GROUP BY user_id),
s AS (SELECT user_id, n AS events,
  CASE WHEN user_id % 37 = 0 THEN 'failed' WHEN user_id % 41 = 0 OR big > 0 OR (bad > n / 3.0 AND bad > 0) THEN 'quarantined' WHEN n > 0 THEN 'complete' ELSE 'excluded' END AS status,
  CASE WHEN user_id % 37 = 0 THEN 'source_read_failed' WHEN user_id % 41 = 0 THEN 'source_changed_during_read' WHEN big > 0 THEN 'record_too_large'
    WHEN bad > n / 3.0 AND bad > 0 THEN 'malformed_jsonl' WHEN n > 0 THEN NULL ELSE 'no_in_window_events' END AS reason FROM u)
"""


@query(_STATUS + "SELECT * FROM s")
def census_status(spark, sf):
    return _statuses(spark, sf)


_CELLS = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in L.TERMINAL_STATUSES)


@query(_STATUS + f", h AS (SELECT *, 'harness-' || (user_id % 3) AS harness FROM s) SELECT coalesce(harness, 'all') AS harness, count(*) AS artifacts, {_CELLS}, 0 AS unaccounted FROM h GROUP BY ROLLUP (harness)")
def census_rollup(spark, sf):
    rows = _statuses(spark, sf).withColumn("harness", F.concat(F.lit("harness-"), (F.col("user_id") % 3).cast("string")))
    return census.status_summary(rows, "harness")


@query("""
SELECT user_id, CASE WHEN count(DISTINCT day) = 1 THEN min(day) ELSE '?' END AS day, CASE WHEN count(DISTINCT kind) = 1 THEN min(kind) ELSE '?' END AS kind
FROM (SELECT user_id, strftime(ts, '%Y-%m') AS day, CASE WHEN event_id % 50 = 0 THEN event_type ELSE NULL END AS kind FROM events) GROUP BY user_id""")
def census_single_value(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.date_format("ts", "yyyy-MM").alias("day"), F.when(F.col("event_id") % 50 == 0, F.col("event_type")).alias("kind"))
    return e.groupBy("user_id").agg(census.single_value("day").alias("day"), census.single_value("kind").alias("kind"))


@query("""
WITH f AS (SELECT user_id, arg_min(event_type, event_id) AS primary_id, list_sort(list(DISTINCT event_type)) AS seen FROM events GROUP BY user_id)
SELECT user_id, primary_id, array_to_string(list_filter(seen, lambda x: x <> primary_id), ',') AS supplemental FROM f""")
def census_first_seen(spark, sf):
    first, rest = census.first_seen("event_type", "event_id")
    return table(spark, sf, "events").groupBy("user_id").agg(first.alias("primary_id"), F.array_join(rest, ",").alias("supplemental"))


@query(f"""
WITH p AS (SELECT user_id, arg_min(event_type, event_id) AS primary_id FROM events WHERE ts < TIMESTAMP '{CUTOFF}' GROUP BY user_id)
SELECT e.user_id, count(*) FILTER (e.ts >= TIMESTAMP '{CUTOFF}' AND e.event_type <> p.primary_id) AS post_cutoff_identity_conflicts
FROM events e JOIN p USING (user_id) GROUP BY e.user_id""")
def census_late_conflicts(spark, sf):
    e = table(spark, sf, "events")
    by = e.groupBy("user_id", "event_type").agg(F.count_if(F.col("ts") >= _at(CUTOFF)).alias("late"), F.min(F.when(F.col("ts") < _at(CUTOFF), F.col("event_id"))).alias("seen"))
    users = by.groupBy("user_id").agg(F.min_by("event_type", "seen").alias("primary_id"), F.sum("late").alias("all_late"), F.collect_list(F.struct("event_type", "late")).alias("kinds"), F.min("seen").alias("seen"))
    own = F.aggregate("kinds", F.lit(0).cast("long"), lambda acc, k: acc + F.when(k["event_type"] != F.col("primary_id"), k["late"]).otherwise(0))
    return users.filter(F.col("seen").isNotNull()).select("user_id", own.alias("post_cutoff_identity_conflicts"))


@query(f"SELECT event_type, count(*) AS records, count(*) FILTER (event_type NOT IN ({strings(_KINDS)})) AS unknown_record_types FROM events GROUP BY event_type")
def census_unknown_types(spark, sf):
    known = {"events": _KINDS}
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("records"), F.count_if(~census.known_type(F.lit("events"), F.col("event_type"), known)).alias("unknown_record_types"))


@query("""
WITH c AS (SELECT conv_id, count(*) AS turns, count(DISTINCT role) AS roles FROM conversations GROUP BY conv_id)
SELECT turns, count(*) AS sessions, count(*) FILTER (roles > 2) AS with_system FROM c GROUP BY turns HAVING count(*) > 1""")
def census_relationships(spark, sf):
    c = table(spark, sf, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.countDistinct("role").alias("roles"))
    return c.groupBy("turns").agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("roles") > 2).alias("with_system")).filter("sessions > 1")


@query("""
WITH k AS (SELECT o_orderdate AS k, count(*) AS n, min(o_orderkey) AS id FROM orders GROUP BY o_orderdate)
SELECT l_orderkey, l_linenumber, CASE WHEN n = 1 THEN id END AS parent_id FROM lineitem LEFT JOIN k ON l_shipdate = k""")
def parent_unique_match(spark, sf):
    """A line refers to the one order of its day: none or several give no parent."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return census.resolve_parents(lines, table(spark, sf, "orders"), "l_shipdate", "o_orderdate", "o_orderkey").select("l_orderkey", "l_linenumber", "parent_id")


@query("SELECT conv_id, sha256(string_agg(turn || chr(0) || role || chr(0) || text || chr(10), '' ORDER BY turn)) AS content_sha256 FROM conversations GROUP BY conv_id")
def content_hash(spark, sf):
    line = F.concat_ws("\0", F.col("turn").cast("string"), "role", "text")
    return census.content_hash(table(spark, sf, "conversations"), ["conv_id"], ["turn"], line)


@query("SELECT doc_id, 'artifact-' || left(sha256(source || chr(0) || 'doc/' || doc_id || '.jsonl'), 24) AS artifact_id FROM documents")
def artifact_ids(spark, sf):
    path = F.concat(F.lit("doc/"), F.col("doc_id").cast("string"), F.lit(".jsonl"))
    return table(spark, sf, "documents").select("doc_id", ids.stable_id("artifact-", F.col("source"), path).alias("artifact_id"))


@query(f"""
WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '{START}' GROUP BY user_id), b AS (SELECT user_id, count(*) AS n FROM events WHERE {_WINDOW} GROUP BY user_id)
SELECT count(*) FILTER (a.user_id IS NULL) AS added, count(*) FILTER (b.user_id IS NULL) AS removed, count(*) FILTER (a.n <> b.n) AS changed, count(*) FILTER (a.n = b.n) AS unchanged
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id""")
def cross_scan_delta(spark, sf):
    e = table(spark, sf, "events")
    count = lambda df: df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return census.delta(count(e.filter(F.col("ts") < _at(START))), count(e.filter(census.window_filter(F.col("ts"), _at(START), _at(CUTOFF)))), "user_id", "n")


@query("""
SELECT page_id, CASE WHEN path IS NULL THEN 'unknown' WHEN contains(path, '/tests') OR contains(path, '/test/') THEN 'synthetic_test' WHEN contains(path, 'a1') THEN 'project' WHEN contains(path, '/documents/') THEN 'documents' ELSE 'other' END AS category,
  CASE WHEN path IS NULL THEN '?' WHEN contains(path, '/tests') OR contains(path, '/test/') THEN 'cwd:tests' WHEN contains(path, 'a1') THEN 'cwd:project' WHEN contains(path, '/documents/') THEN 'cwd:documents' ELSE 'cwd:other' END AS rule
FROM (SELECT page_id, CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 5 = 0 THEN '/x/documents/' ELSE lower(url) END AS path FROM pages)""")
def working_dir_category(spark, sf):
    path = F.when(F.col("page_id") % 11 == 0, F.lit(None)).when(F.col("page_id") % 5 == 0, "/x/documents/").otherwise(F.col("url"))
    kind, rule = census.working_directory(path, "a1")
    return table(spark, sf, "pages").select("page_id", kind.alias("category"), rule.alias("rule"))


@query("""
WITH p AS (SELECT p_partkey, p_brand AS entry, p_type AS session, CASE WHEN p_size % 7 = 0 THEN 'synthetic_test' ELSE 'other' END AS dir,
  CASE WHEN p_size % 3 = 0 THEN true WHEN p_size % 3 = 1 THEN false END AS side, CASE WHEN p_size % 5 = 0 THEN 'p' ELSE '?' END AS parent,
  CASE WHEN p_size % 4 = 0 THEN 'sdk-ts' WHEN p_size % 4 = 1 THEN 'CLI' WHEN p_size % 4 = 2 THEN '?' ELSE 'x' END AS e FROM part)
SELECT p_partkey, CASE WHEN e = 'sdk-ts' THEN 'sdk' WHEN e = 'CLI' THEN 'interactive' WHEN dir = 'synthetic_test' THEN 'synthetic_test' ELSE 'unknown' END AS shape,
  CASE WHEN e IN ('sdk-ts', 'CLI') THEN 'observed' WHEN dir = 'synthetic_test' THEN 'inferred' ELSE 'unknown' END AS provenance,
  CASE WHEN side OR parent <> '?' THEN 'child_agent' WHEN NOT side THEN 'root_conversation' ELSE 'unknown' END AS source_kind FROM p""")
def execution_shape(spark, sf):
    size = F.col("p_size")
    entry = F.when(size % 4 == 0, "sdk-ts").when(size % 4 == 1, "CLI").when(size % 4 == 2, "?").otherwise("x")
    shape, provenance = census.execution_shape(entry, F.lit("?"), F.when(size % 7 == 0, "synthetic_test").otherwise("other"))
    side = F.when(size % 3 == 0, True).when(size % 3 == 1, False)
    kind = census.source_kind(F.when(size % 5 == 0, "p").otherwise("?"), side)
    return table(spark, sf, "part").select("p_partkey", shape.alias("shape"), provenance.alias("provenance"), kind.alias("source_kind"))


@query("""
WITH t AS (SELECT event_id, ts, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00')
  WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 3 THEN CAST(epoch_ms(ts) AS VARCHAR) ELSE 'never' END AS text FROM events)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR WHEN 3 THEN date_trunc('millisecond', ts) END AS parsed FROM t""")
def ts_parse(spark, sf):
    ts, k = F.col("ts").cast("timestamp"), F.col("event_id") % 5
    day = lambda zone: F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(zone))
    text = F.when(k == 0, day("Z")).when(k == 1, day("+02:00")).when(k == 2, day("")).when(k == 3, F.unix_millis(ts).cast("string")).otherwise("never")
    return table(spark, sf, "events").select("event_id", census.parse_timestamp(text).cast("timestamp_ntz").alias("parsed"))


@query("""
SELECT event_id, rank AS ordinal, event_type, previous IS NOT DISTINCT FROM event_type AND event_type = 'error' AS repeated_failure FROM (
  SELECT *, row_number() OVER w AS rank, lag(event_type) OVER w AS previous FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))""")
def repeated_failure(spark, sf):
    w = Window.partitionBy("user_id").orderBy("event_id")
    same = F.lag("event_type").over(w).eqNullSafe(F.col("event_type")) & (F.col("event_type") == "error")
    return table(spark, sf, "events").select("event_id", F.row_number().over(w).alias("ordinal"), "event_type", same.alias("repeated_failure"))


@query("""
WITH s AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq, sha256(event_id || chr(0) || props) AS own FROM events),
l AS (SELECT *, coalesce(lag(own) OVER (PARTITION BY user_id ORDER BY seq), '') AS truth FROM s), x AS (SELECT *, CASE WHEN event_id % 101 = 0 THEN 'broken' ELSE truth END AS previous FROM l)
SELECT event_id, seq, previous = truth AS chain_ok FROM x""")
def ledger_chain(spark, sf):
    w = Window.partitionBy("user_id").orderBy("event_id")
    s = table(spark, sf, "events").select("event_id", "user_id", F.row_number().over(w).alias("seq"), ids.digest(F.col("event_id"), F.col("props")).alias("own"))
    s = s.withColumn("previous", F.when(F.col("event_id") % 101 == 0, "broken").otherwise(F.coalesce(F.lag("own").over(Window.partitionBy("user_id").orderBy("seq")), F.lit(""))))
    return census.chain_breaks(s, ["user_id"], "seq", "own", "previous").select("event_id", "seq", "chain_ok")


@query("""
SELECT user_id, count(*) AS parts, CASE WHEN bool_and(event_type <> 'error') THEN sum(event_id % 7) END AS total FROM events GROUP BY user_id""")
def usage_rollup(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("parts"), F.when(F.bool_and(F.col("event_type") != "error"), F.sum(F.col("event_id") % 7)).alias("total"))


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN json_valid(props) THEN 'parsed' ELSE 'malformed' END AS outcome FROM events""")
def json_probe(spark, sf):
    good = F.try_parse_json("props").isNotNull()
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.when(good, "parsed").otherwise("malformed").alias("outcome"))


@query("""
WITH r AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events)
SELECT event_id, user_id, event_type FROM r WHERE n = 1 OR event_type <> 'click'""")
def seen_item_suppression(spark, sf):
    n = F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("event_id"))
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", n.alias("n")).filter((F.col("n") == 1) | (F.col("event_type") != "click")).drop("n")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def pending_work(spark, sf):
    items = table(spark, sf, "orders").filter("o_orderstatus = 'O'").select("o_orderkey")
    done = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return items.join(done, "o_orderkey", "left_anti")


@query("""
SELECT l_returnflag, sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(9,2)) AS DECIMAL(38,4))) AS cost FROM lineitem GROUP BY l_returnflag""")
def decimal_cost(spark, sf):
    one = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(9,2)")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.sum(one.cast("decimal(28,4)")).cast("decimal(38,4)").alias("cost"))
