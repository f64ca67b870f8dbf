"""Packets, candidate documents, the provider seam and sinks."""

import json
import os
import stat

import pytest
from pyspark.sql import functions as F

from siftline.operators import documents, packets, provider
from siftline.sources import sinks

EVENT = "artifact_id string, harness string, ordinal int, part int, role string, strength string, text string, event_id string"


def events(spark, rows):
    return spark.createDataFrame([(a, "claude", o, 1, r, "asserted", t, f"{a}-e{o}") for a, o, r, t in rows], EVENT)


def test_packets_and_outcomes(spark):
    rows = [("a", k, "user", f"text {k} " * 40) for k in range(20)]
    rows += [("b", 1, "user", "fine"), ("b", 2, "system", "do this"), ("b", 3, "user", "AKIA" + "B" * 16)]
    rows += [("c", 1, "user", "mail x@y.org <b>"), ("d", 1, "user", "AKIA" + "B" * 16), ("e", 1, "user", "z" * 3000)]
    checked = packets.checked_events(events(spark, rows)).cache()
    got = {r.artifact_id: (r.status, r.reason) for r in packets.artifact_outcomes(checked).collect()}
    fine = ("prepared_no_egress", None)
    assert got == {"a": fine, "b": ("quarantined", "instruction_role_content"), "c": fine, "d": ("quarantined", "credential_detected"), "e": fine}
    built = packets.build_packets(checked, max_bytes=2500).cache()
    mine = [r for r in sorted(built.filter("artifact_id = 'a'").collect(), key=lambda r: r.packet)]
    assert sum((r.event_ids for r in mine), []) == [f"a-e{k}" for k in range(20)] and len(mine) > 1
    assert all(r.bytes <= 2500 and r.tokens == -(-r.bytes // 3) for r in mine)
    assert built.filter("artifact_id = 'e'").count() == 0  # one event is larger than a packet
    one = json.loads(built.filter("artifact_id = 'c'").first().events[0])
    assert one["text"] == "mail [REDACTED:email] &lt;b&gt;" and one["evidence_uri"] == "session://claude/c@1#event=c-e1"
    assert packets.unsafe_packets(built).count() == 0
    cover = {(r.event_id, r.disposition) for r in packets.event_coverage(checked, built).collect()}
    assert ("a-e3", "packet") in cover and ("b-e1", "quarantined") in cover and len(cover) == len(rows)


def test_compact_cuts_the_first(spark):
    long = "é" * 5000
    checked = packets.checked_events(events(spark, [("a", 1, "user", long), ("a", 2, "user", "x"), ("b", 1, "user", "s"), ("b", 2, "user", "t")]))
    got = {r.event_ids[0][0]: r.texts for r in packets.compact(packets.build_packets(checked)).collect()}
    assert got["b"] == ["s", "t"]
    assert got["a"] == ["é" * ((4096 - 256) // 2)]


CAND = {"topic": "seo", "learning_type": "finding", "claim_label": "[DATA]", "summary": "s", "title": "t", "recommended_action": "r", "transferability_rationale": "w", "evidence_uris": ["u1"]}


def test_candidate_documents(spark):
    schema = f"packet_id string, result_type string, no_learning_reason string, candidates array<{documents.CANDIDATE}>"
    base = spark.createDataFrame([("p", "candidates", None, [{**CAND, "candidate_id": "x"}])], schema)
    stable = base.select(documents.stable_candidate_id(F.col("packet_id"), F.col("candidates")[0]).alias("i")).first().i
    good = {**CAND, "candidate_id": stable}
    rows = [
        ("p", "candidates", None, [good]), ("q", "candidates", None, [good, good]), ("p", "candidates", None, []), ("p", "no_learning", " ", [good]), ("p", "no_learning", "none", []),
        ("p", "other", None, []), ("p", "candidates", None, [{**good, "topic": "x", "claim_label": "?", "evidence_uris": ["u9", "u2"]}]), ("p", "candidates", None, [{**good, "evidence_uris": ["u2"]}]),
    ]
    known = spark.createDataFrame([("p", {"u1": "observed", "u2": "asserted"})], "packet_id string, strengths map<string,string>")
    got = [(r.errors, r.terminal_status) for r in documents.validate(spark.createDataFrame(rows, schema).coalesce(1), known).collect()]
    assert ([], "extracted") in got and ([], "no_learning") in got
    assert (["candidates:minItems"], "rejected_invalid") in got
    assert (["no_learning.candidates:must_be_empty", "no_learning_reason:required"], "rejected_invalid") in got
    assert (["result_type:invalid"], "rejected_invalid") in got
    flat = [e for errors, _ in got for e in errors]
    for code in ("candidate[1].candidate_id:duplicate", "document.packet_id:packet_mismatch", "candidate[0].topic:unsupported", "candidate[0].claim_label:unsupported", "candidate[0].candidate_id:not_stable", "candidate.evidence_uris[0]:not_in_packet", "candidate.evidence_uris[0]:not_observed"):
        assert code in flat


def test_release_gate(spark):
    good = dict(harness="claude", prompt_sha256="p", policy_version="v", approved_fields=["a"], r_provider="anthropic", r_account="authenticated-first-party-claude", r_account_verified=True, r_model="m", r_model_verified=True, r_prompt_sha256="p", r_policy_version="v", r_approved_fields=["a"], r_raw_tools=[], r_fallback_provider=None, r_transport_verified=True)
    rows = [good, {**good, "harness": "x"}, {**good, "r_provider": "openai", "r_model": " ", "r_raw_tools": ["t"], "r_transport_verified": None, "r_fallback_provider": "y"}]
    schema = "harness string, prompt_sha256 string, policy_version string, approved_fields array<string>, r_provider string, r_account string, r_account_verified boolean, r_model string, r_model_verified boolean, r_prompt_sha256 string, r_policy_version string, r_approved_fields array<string>, r_raw_tools array<string>, r_fallback_provider string, r_transport_verified boolean"
    got = [r.e for r in spark.createDataFrame(rows, schema).coalesce(1).select(provider.release_errors().alias("e")).collect()]
    assert got == [[], ["work_item_harness_invalid"], ["fallback_provider_forbidden", "model_unverified", "provider_affinity_mismatch", "raw_tools_not_disabled", "transport_unverified"]]


def test_usage_cost_unwrap_codes(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    n = lambda v: F.lit(v).cast("long")
    assert one(provider.total_input_tokens(n(2), n(1000), n(4000))) == 5002
    assert one(provider.total_input_tokens(n(2), n(None), n(None))) is None and one(provider.total_input_tokens(n(200), n(None), n(None))) == 200
    assert str(one(provider.cost(F.lit(1), F.lit(1), "0.5", "1.0"))) == "0.000002"  # 1.5 millionths, half up
    assert json.loads(one(provider.unwrap(F.lit('{"result": "{\\"candidates\\": []}"}')))) == {"candidates": []}
    assert one(provider.unwrap(F.lit('{"other": 1}'))) is None
    assert one(provider.failure_code(F.lit("rate limit: 429!"))) == "ratelimit429" and one(provider.failure_code(F.lit("!!"))) == "provider_failure"


def test_attempts_stop_at_a_repeat(spark):
    rows = [("w", 1, "a"), ("w", 2, "b"), ("w", 3, "b"), ("w", 4, "c"), ("v", 1, "a")]
    got = provider.attempts(spark.createDataFrame(rows, "item string, at int, failure string"), "item", "at", "failure").collect()
    assert sorted((r.item, r.attempt_number, r.status) for r in got) == [("v", 1, "retrying"), ("w", 1, "retrying"), ("w", 2, "retrying"), ("w", 3, "failed")]


def test_batches_run_once(spark):
    items = spark.createDataFrame([("b1", "w2", "y"), ("b1", "w1", "x"), ("b2", "w3", "boom"), ("b3", "w4", "short")], "batch_id string, work_item_id string, payload string")

    def runner(payloads):
        if payloads == ["boom"]:
            raise RuntimeError("secret text")
        return [] if payloads == ["short"] else [p.upper() for p in payloads]

    got = sorted(tuple(r) for r in provider.run_batches(items, runner).collect())
    assert got == [("b1", "w1", "complete", "X"), ("b1", "w2", "complete", "Y"), ("b2", "w3", "failed", "RuntimeError"), ("b3", "w4", "failed", "coverage_mismatch")]
    done = spark.createDataFrame([("b1",), ("b2",)], "batch_id string")
    assert [r.batch_id for r in provider.run_batches(items, runner, done).collect()] == ["b3"]


def test_write_once_and_ledger(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = lambda *rows: spark.createDataFrame(rows, "k string, v string")
    assert sinks.write_once(df(("a", "1"), ("b", "2")), path, "k") == 2
    assert sinks.write_once(df(("a", "1"), ("c", "3")), path, "k") == 1
    with pytest.raises(sinks.ConflictError):
        sinks.write_once(df(("a", "other")), path, "k")
    assert spark.read.parquet(path).count() == 3
    ledger = f"file://{tmp_path}/l"
    row = lambda k, s: spark.createDataFrame([(k, s)], "k string, status string")
    sinks.append_terminal(row("a", "failed"), ledger, "k", ("failed", "done"))
    for bad, error in ((row("a", "done"), sinks.ConflictError), (row("b", "odd"), ValueError)):
        with pytest.raises(error):
            sinks.append_terminal(bad, ledger, "k", ("failed", "done"))


def test_private_documents_and_page(tmp_path):
    path = str(tmp_path / "p" / "d.json")
    sinks.private_document(path, {"b": 1, "a": "é"})
    assert open(path).read() == '{"a":"é","b":1}\n' and stat.S_IMODE(os.stat(path).st_mode) == 0o600 and stat.S_IMODE(os.stat(os.path.dirname(path)).st_mode) == 0o700
    body = sinks.page([{"topic": 'a"b', "title": "<script>x</script>"}], "T & U", ("title",))
    assert "<script>x" not in body and "&lt;script&gt;x" in body and "a&quot;b" in body and "T &amp; U" in body
