"""Queries over documents, pages and benchmark: redaction, tokens, novelty, probe gates."""

from __future__ import annotations


from pyspark.sql import functions as F

from siftline.functions import schema, text
from siftline.functions import lexicons as L
from siftline.operators import probe, review
from siftline.plans.registry import query, strings, table

#: The test data's words stand in for the lexicons: frequent ones of its languages.
MARKETING, DECISION, HARNESS = ("the", "les", "der", "que", "and"), ("that", "this", "dans", "ist", "for"), ("with", "mit", "par", "was")
_FOLD = "replace(lower(coalesce({0}, '')), 'ß', 'ss')"


def _tokens(col: str) -> str:
    return f"list_distinct(regexp_extract_all({_FOLD.format(col)}, '[a-z0-9_]+'))"


def _shared(tokens: str, lexicon) -> str:
    return f"CAST(len(list_intersect({tokens}, [{strings(lexicon)}])) AS INTEGER)"


_SYN = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in L.SYNONYMS.items()) + "}"


def _semantic(col: str) -> str:
    return f"""list_distinct(list_filter(list_transform(list_filter(regexp_extract_all({_FOLD.format(col)}, '[a-z0-9]+'), lambda w: w NOT IN ({strings(L.STOP_WORDS)})),
  lambda w: coalesce({_SYN}[w], w)), lambda w: length(w) > 2))"""


@query("SELECT doc_id, regexp_replace(text, '(?i)\\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{2,}\\b', '[REDACTED:email]', 'g') AS redacted FROM documents")
def redact_email(spark, sf):
    out = text.redacted(F.col("text"), L.REDACTIONS[:1])
    return table(spark, sf, "documents").select("doc_id", out["text"].alias("redacted"))


@query()
def redact_full(spark, sf):
    """All five rules in order, then escaping; RE2 has no look-around, so there is no SQL (tested)."""
    out = table(spark, sf, "documents").select("doc_id", text.redacted(F.col("text")).alias("r"))
    return out.select("doc_id", text.escape_markup(F.col("r.text")).alias("redacted"), F.col("r.count").alias("redactions"))


@query()
def redact_phone(spark, sf):
    out = table(spark, sf, "documents").select("doc_id", text.redacted(F.col("text"), L.REDACTIONS[1:2]).alias("r"))
    return out.select("doc_id", F.col("r.text").alias("redacted"), F.col("r.count").alias("redactions")).filter("redactions > 0")


@query("""
SELECT page_id, replace(replace(replace(replace(regexp_replace(html, '&(amp;|lt;|gt;|quot;|#[0-9]+;|#x[0-9a-fA-F]+;)', chr(1) || '\\1', 'g'), '&', '&amp;'), chr(1), '&'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages""")
def html_escape(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.escape_markup(F.col("html")).alias("escaped"))


def _rule(i: str, p: str) -> str:
    """RE2 has no look-ahead: where one forbids //, the match must begin otherwise."""
    at = p.find("(?!//)")
    if at < 0:
        return f"CASE WHEN regexp_matches(t, '{p}') THEN '{i}' END"
    before, signs = p[:at], p[at + 6 :]
    kind = signs[: signs.index("]") + 1]
    slashless = kind.replace("/", "")
    return f"CASE WHEN regexp_matches(t, '{before}(?:{slashless}{kind}{{15,}}|/{slashless}{kind}{{14,}})') THEN '{i}' END"


_CRED = "list_sort(list_filter([" + ", ".join(_rule(i, p) for i, p in L.CREDENTIALS) + "], lambda x: x IS NOT NULL))"


@query(f"""
WITH t AS (SELECT doc_id, text || CASE doc_id % 20 WHEN 3 THEN ' AKIA' || 'ABCDEFGHIJKLMNOP' WHEN 5 THEN ' Bearer ' || sha256(text) WHEN 7 THEN ' ghp_' || sha256(text) WHEN 9 THEN ' csrf: ' || sha256(text) WHEN 11 THEN ' session_token= //' || sha256(text) ELSE '' END AS t FROM documents)
SELECT doc_id, {_CRED} AS rules FROM t""")
def credential_scan(spark, sf):
    k, h = F.col("doc_id") % 20, F.sha2("text", 256)
    spiked = F.concat("text", F.when(k == 3, " AKIA" + "ABCDEFGHIJKLMNOP").when(k == 5, F.concat(F.lit(" Bearer "), h)).when(k == 7, F.concat(F.lit(" ghp_"), h)).when(k == 9, F.concat(F.lit(" csrf: "), h)).when(k == 11, F.concat(F.lit(" session_token= //"), h)).otherwise(""))
    return table(spark, sf, "documents").select("doc_id", spiked.alias("t")).select("doc_id", text.credential_ids(F.col("t")).alias("rules"))


@query("SELECT page_id, " + " OR ".join(f"regexp_matches(html, '{p}')" for p in L.MARKUP) + " AS unsafe FROM pages")
def unsafe_scan(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.has_markup(F.col("html")).alias("unsafe"))


@query("""
WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents), n AS (SELECT doc_id, ch, count(*) AS n FROM c GROUP BY doc_id, ch), t AS (SELECT doc_id, sum(n) AS total FROM n GROUP BY doc_id)
SELECT d.doc_id, coalesce(b.bits, 0.0) AS bits FROM documents d LEFT JOIN (SELECT doc_id, round(-sum(n / total * log2(n / total)), 6) AS bits FROM n JOIN t USING (doc_id) GROUP BY doc_id) b USING (doc_id)""")
def entropy(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(text.entropy(F.col("text")), 6).alias("bits"))


@query()
def high_entropy_secret(spark, sf):
    """Needs match offsets, so an Arrow UDF; no SQL (tested)."""
    return table(spark, sf, "documents").select("doc_id", text.high_entropy_secret()("text").alias("secret"))


@query()
def injected_blocks(spark, sf):
    """Registered blocks are cut out, others quarantine: pages, with the 20 most frequent <script> blocks registered (tested)."""
    known = probe.block_digests(table(spark, sf, "pages"), "html", "<script>", "</script>", 20)
    return probe.strip_blocks(table(spark, sf, "pages").select("page_id", "html"), "html", [("script", "<script>", "</script>", known)]).select("page_id", "status", "reason", "excluded", F.length("remaining").alias("remaining_chars"))


@query("SELECT doc_id, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS fingerprint FROM documents")
def fingerprint(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.fingerprint(F.col("text")).alias("fingerprint"))


@query(f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(list_sort(t), ' ') AS tokens FROM (SELECT doc_id, {_tokens('text')} AS t FROM documents)")
def token_sets(spark, sf):
    t = text.tokens(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(t).alias("n"), F.array_join(F.array_sort(t), " ").alias("tokens"))


@query(f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(list_sort(t), ' ') AS tokens FROM (SELECT doc_id, {_semantic('text')} AS t FROM documents)")
def semantic_tokens(spark, sf):
    t = text.semantic_tokens(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(t).alias("n"), F.array_join(F.array_sort(t), " ").alias("tokens"))


_SCORES = f"""
WITH s AS (SELECT doc_id, source, 5 * {_shared('t', MARKETING)} + 2 * {_shared('t', DECISION)} + {_shared('t', HARNESS)} AS score FROM (SELECT doc_id, source, {_tokens('text')} AS t FROM documents))
"""


def _scored(spark, sf):
    # the tokens are a column of their own, so that they are found once
    t = table(spark, sf, "documents").select("doc_id", "source", text.tokens(F.col("text")).alias("t"))
    return t.select("doc_id", "source", text.marketing_score(F.col("t"), MARKETING, DECISION, HARNESS).alias("score"))


@query(_SCORES + "SELECT source, doc_id, score, CAST(k AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS k FROM s WHERE score > 0) WHERE k <= 16")
def marketing_score_topk(spark, sf):
    return probe.top_events(_scored(spark, sf), ["source"], 16)


@query(_SCORES + "SELECT source, sum(CASE WHEN score > 20 THEN 1 ELSE 0 END) AS marketing, count(*) AS events FROM s GROUP BY source ORDER BY marketing DESC, events DESC, source LIMIT 8")
def root_topk(spark, sf):
    by = _scored(spark, sf).groupBy("source").agg(F.sum(F.when(F.col("score") > 20, 1).otherwise(0)).alias("marketing"), F.count(F.lit(1)).alias("events"))
    return by.orderBy(F.desc("marketing"), F.desc("events"), "source").limit(8)


_NOVEL = f"""
WITH c AS (SELECT doc_id, {_semantic('text')} AS t FROM documents), b AS (SELECT item_id, {_semantic('text')} AS t FROM benchmark),
p AS (SELECT doc_id, item_id, len(list_intersect(c.t, b.t)) AS i, len(list_distinct(list_concat(c.t, b.t))) AS u, list_sort(c.t) = list_sort(b.t) AS same FROM c CROSS JOIN b),
m AS (SELECT doc_id, arg_min(CASE WHEN same THEN 'exact' ELSE 'semantic' END || '_baseline_match:' || item_id, CAST(item_id AS VARCHAR)) AS first FROM p WHERE same OR (i >= 4 AND i * 1.0 / u >= 0.1) GROUP BY doc_id)
"""


@query(_NOVEL + "SELECT c.doc_id, coalesce(first, 'novel') AS outcome FROM c LEFT JOIN m USING (doc_id)")
def jaccard_novelty(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", text.semantic_tokens(F.col("text")).alias("tokens"))
    base = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), text.semantic_tokens(F.col("text")).alias("tokens"))
    return probe.novelty(docs, base, "doc_id", least_shared=4, threshold=0.1)


@query(f"""
WITH t AS (SELECT doc_id, {_tokens('text')} AS t FROM documents), n AS (SELECT doc_id, {_shared('t', MARKETING)} AS m, {_shared('t', DECISION)} AS d, {_shared('t', HARNESS)} AS h FROM t)
SELECT doc_id, m AS marketing_terms, d AS decision_terms, h AS harness_terms, CASE WHEN m >= 2 AND d >= 1 AND m > h THEN 'likely_learning' ELSE 'no_learning' END AS expectation FROM n""")
def learning_expectation(spark, sf):
    t = table(spark, sf, "documents").select("doc_id", text.tokens(F.col("text")).alias("t"))
    n = t.select("doc_id", text.shared(F.col("t"), MARKETING).alias("marketing_terms"), text.shared(F.col("t"), DECISION).alias("decision_terms"), text.shared(F.col("t"), HARNESS).alias("harness_terms"))
    likely = (F.col("marketing_terms") >= 2) & (F.col("decision_terms") >= 1) & (F.col("marketing_terms") > F.col("harness_terms"))
    return n.withColumn("expectation", F.when(likely, "likely_learning").otherwise("no_learning"))


_REASONS = f"""
WITH t AS (SELECT doc_id, source, lang, {_semantic('text')} AS t FROM documents),
r AS (SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN 'missing_required_field' WHEN lang = 'es' THEN 'invalid_claim_label' WHEN doc_id % 13 = 0 THEN 'invalid_evidence'
  WHEN {_shared('t', ('with', 'mit', 'was'))} > 0 AND {_shared('t', ('les', 'der', 'and'))} = 0 THEN 'harness_only' WHEN {_shared('t', ('les', 'der', 'and'))} = 0 THEN 'not_marketing' ELSE 'accepted' END AS reason FROM t)
"""


def _reasons(spark, sf):
    t = table(spark, sf, "documents").select("doc_id", "lang", text.semantic_tokens(F.col("text")).alias("t"))
    marketing = text.shared(F.col("t"), ("les", "der", "and"))
    checks = [(F.col("doc_id") % 17 == 0, "missing_required_field"), (F.col("lang") == "es", "invalid_claim_label"), (F.col("doc_id") % 13 == 0, "invalid_evidence"), ((text.shared(F.col("t"), ("with", "mit", "was")) > 0) & (marketing == 0), "harness_only"), (marketing == 0, "not_marketing")]
    return t.select("doc_id", review.first_reason(checks).alias("reason"))


@query(_REASONS + "SELECT * FROM r")
def probe_decision_reason(spark, sf):
    return _reasons(spark, sf)


@query(_REASONS + "SELECT reason, count(*) AS candidates, reason = 'accepted' AS accepted FROM r GROUP BY reason")
def validation_summary(spark, sf):
    return _reasons(spark, sf).groupBy("reason").agg(F.count(F.lit(1)).alias("candidates")).withColumn("accepted", F.col("reason") == "accepted")


def _topic_case(col: str, rules, default: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains({col}, '{t}')" for t in terms) + f" THEN '{name}'" for name, terms in rules) + f" ELSE {default} END"


_WORDS = ("seo campaign", "landing page", "team strategy", "pricing api change control", "lead pipeline", "thought leadership", "messaging", "retention benchmark")
_PHRASE = "[" + strings(_WORDS) + "][1 + p_partkey % 8]"


@query(f"""
WITH t AS (SELECT p_partkey, lower(p_type) AS topic, lower(p_name || ' ' || {_PHRASE}) AS body FROM part)
SELECT p_partkey, {_topic_case("replace(topic, '_', ' ')", L.SOURCE_TOPIC_RULES, _topic_case("(' ' || body || ' ')", L.TEXT_TOPIC_RULES, "'leadership_strategy'"))} AS topic FROM t""")
def topic_suggest(spark, sf):
    phrase = F.element_at(text.words(_WORDS), (F.col("p_partkey") % 8 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", text.suggest_topic(F.col("p_type"), F.concat_ws(" ", "p_name", phrase)).alias("topic"))


@query(f"WITH t AS (SELECT p_partkey, lower({_PHRASE} || ['', ' metric', ' process', ' media'][1 + p_size % 4]) AS kind FROM part) SELECT p_partkey, {_topic_case('kind', L.TYPE_RULES, chr(39) + 'finding' + chr(39))} AS learning_type FROM t")
def type_suggest(spark, sf):
    phrase = F.element_at(text.words(_WORDS), (F.col("p_partkey") % 8 + 1).cast("int"))
    suffix = F.element_at(text.words(("", " metric", " process", " media")), (F.col("p_size") % 4 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", text.suggest_type(F.concat(phrase, suffix)).alias("learning_type"))


@query("SELECT doc_id, source FROM documents WHERE contains(lower(text), 'the') AND source = 'src3'")
def publication_search(spark, sf):
    return table(spark, sf, "documents").filter(F.contains(F.lower("text"), F.lit("the")) & (F.col("source") == "src3")).select("doc_id", "source")


@query("SELECT lang, count(*) AS docs, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, CAST(sum((octet_length(encode(text)) + 2) // 3) AS BIGINT) AS tokens FROM documents GROUP BY lang")
def token_estimate(spark, sf):
    n = F.octet_length("text")
    return table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum(n).alias("bytes"), F.sum(F.floor((n + 2) / 3).cast("long")).alias("tokens"))


#: A schema with every keyword that is checked.
EVENT_SCHEMA = {
    "type": "object", "required": ["id", "kind", "tags", "props"], "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 10}, "kind": {"enum": ["click", "view", "purchase", "signup"]}, "version": {"const": "v1"},
        "tags": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"type": "string", "pattern": "[a-z]+"}}, "props": {"$ref": "#/$defs/props"},
    },
    "$defs": {"props": {"type": "object", "minProperties": 1, "required": ["k"], "properties": {"k": {"type": ["integer", "boolean"]}}}},
}


@query("""
SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 8 = 5 THEN '$.tags:required' END, CASE WHEN event_id % 8 = 5 THEN '$.extra:unexpected' END, CASE WHEN event_id < 10 THEN '$.id:minimum' END,
  CASE WHEN event_type = 'error' THEN '$.kind:enum' END, CASE WHEN event_id % 8 = 1 THEN '$.version:const' END, CASE event_id % 8 WHEN 2 THEN '$.tags:minItems' WHEN 3 THEN '$.tags:uniqueItems' WHEN 4 THEN '$.tags[0]:pattern,$.tags[1]:expected_string' END,
  CASE event_id % 8 WHEN 6 THEN '$.props:minProperties,$.props.k:required' WHEN 7 THEN '$.props.k:expected_integer|boolean' END], lambda x: x IS NOT NULL), ',') AS errors FROM events""")
def schema_errors(spark, sf):
    """Events as JSON documents that break a schema in every way, by event_id % 8."""
    f = F.col("event_id") % 8
    tags = F.when(f == 2, "[]").when(f == 3, '["a","a"]').when(f == 4, '["A",5]').otherwise('["a","b"]')
    props = F.when(f == 6, "{}").when(f == 7, '{"k":"x"}').otherwise(F.col("props"))
    rest = F.when(f == 5, F.lit('"extra":1')).otherwise(F.concat(F.lit('"tags":'), tags))
    body = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"kind":"'), F.col("event_type"), F.when(f == 1, '","version":"v2",').otherwise('","version":"v1",'), rest, F.lit(',"props":'), props, F.lit("}"))
    return table(spark, sf, "events").select("event_id", F.array_join(schema.schema_errors(body, EVENT_SCHEMA), ",").alias("errors"))


@query("""
SELECT lang, doc_id, rank FROM (SELECT lang, doc_id, CAST(row_number() OVER (PARTITION BY lang ORDER BY sha256('probe' || chr(0) || doc_id)) AS INTEGER) AS rank, count(*) OVER (PARTITION BY lang) AS n FROM documents) WHERE rank <= ceil(n * 0.1)""")
def hash_sample(spark, sf):
    from siftline.operators import groups

    docs = table(spark, sf, "documents").select("lang", "doc_id")
    return groups.hash_sample(docs, "doc_id", "probe", 0.1, ["lang"]).select("lang", "doc_id", F.col("rank").cast("int").alias("rank"))


