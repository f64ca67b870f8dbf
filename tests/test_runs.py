"""Whole runs with made-up providers, and whole files."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siftline.operators import review
from siftline.plans import runs
from siftline.sources import files

OK = {"harness": "claude", "provider": "anthropic", "account": "authenticated-claude"}


@pytest.fixture
def probe(spark):
    sample = spark.createDataFrame([(f"a{k}",) for k in range(8)], "artifact_id string")
    uri = "session://claude/a{}@1#event=e1".format
    packets = spark.createDataFrame([(f"a{k}", "safe", 100, uri(k), "observed" if k % 2 == 0 else "asserted") for k in range(8)], "artifact_id string, status string, bytes long, pointer string, strength string")
    base = spark.createDataFrame([("b1", "pause the campaign when demand for brand search is low")], "id string, text string")
    cand = lambda i, **x: {"id": i, "title": "t", "content": f"increase budget for audience {i}word", "label": "[LOGIC]", "topic": "seo", "type": "finding", "decision": "shift budget", "evidence": [uri(0)], **x}
    return sample, packets, base, cand, uri


def test_probe(spark, probe):
    sample, packets, base, cand, uri = probe
    good = [cand(f"g{k}") for k in range(8)]
    odd = [
        cand("unsafe", title="<script>"), cand("missing", title=""), cand("label", label="[X]"), cand("form", evidence=["u"]), cand("where", evidence=["session://claude/zz@1#event=e1"]), cand("harness", content="retry the agent prompt", decision="retry"),
        cand("off", content="walk the dog", decision="walk"), cand("known", content="Pause campaigns when the demand for brand search is low"), cand("data", label="[DATA]", evidence=[uri(1)]), cand("fine", label="[DATA]"),
    ]
    run = lambda rows, **x: runs.value_probe(**{"sample": sample, "packets": packets, "baseline": base, "release": OK, "dispatch": lambda p: spark.createDataFrame(rows, runs.CANDIDATE), **x})
    got = run(good + odd)
    assert (got.status, got.reason, got.accepted) == ("passed", "r23_passed", 9)
    why = {r.id: r.reason for r in got.decisions.collect() if not r.id.startswith("g")}
    assert why == {
        "unsafe": "unsafe_candidate", "missing": "missing_required_field", "label": "invalid_claim_label", "form": "invalid_evidence", "where": "unresolvable_evidence", "harness": "harness_only", "off": "not_marketing",
        "known": "exact_baseline_match:b1", "data": "data_evidence_not_observed", "fine": "accepted",
    }
    assert run(good[:7]).reason == "r23_threshold_not_met"
    assert run(good, sample=sample.limit(7)).reason == "invalid_sample_size"
    assert run(good, release={**OK, "provider": "openai"}).reason == "provider_affinity_mismatch"
    assert run(good, packets=packets.withColumn("status", F.lit("Quarantined"))).reason == "redaction_quarantine"
    big = run(good, packets=packets.withColumn("bytes", F.lit(1_000_000).cast("long")))
    assert (big.reason, big.dimension) == ("resource_envelope_exceeded", "input_tokens")

    def fails(p):
        raise RuntimeError

    assert run(good, dispatch=fails).reason == "provider_call_failed"


def test_full_corpus(spark):
    rows = [(f"g{k:02d}", "claude" if k % 2 else "codex", "mixed" if k % 3 else "sdk", f"text {k}") for k in range(60)]
    table = spark.createDataFrame(rows, "group_id string, harness string, session_kind string, payload string")
    label = lambda batch: ["marketing_bearing" if int(p.split()[1]) % 4 == 0 else "other" for p in batch]
    out = runs.full_corpus(table, label, lambda batch: [p.upper() for p in batch], share=0.2)
    routed = {r.group_id: (r.route, r.reason) for r in out["routed"].collect()}
    assert sum(r == "marketing_bearing" for _, r in routed.values()) == 15
    others = [k for k in range(60) if k % 4 and k % 3]
    assert sum(r == "mixed_negative_sample" for _, r in routed.values()) == -(-len(others) // 5)
    assert {r.work_item_id: r.result for r in out["extracted"].collect()} == {g: f"TEXT {int(g[1:])}" for g, (route, _) in routed.items() if route == "extraction_pending"}
    with pytest.raises(RuntimeError):
        runs.full_corpus(table, lambda batch: [], lambda batch: batch)


def test_pilot_verdict(spark):
    rows = spark.range(1)
    metrics = rows.select(F.inline(F.array(review.metric("relevance", F.lit(2), F.lit(5), 0.8), review.metric("novelty", F.lit(0), F.lit(0), 1.0))))
    outcomes = spark.createDataFrame([(f"p{k}",) for k in range(24)], "packet_id string")
    assert runs.pilot_verdict(metrics, outcomes).reason == "relevance"
    assert runs.pilot_verdict(metrics.filter("passed"), outcomes).status == "passed"
    assert runs.pilot_verdict(metrics, outcomes.limit(23)).reason == "outcomes_incomplete"


def test_files(spark, tmp_path):
    (tmp_path / "x").mkdir()
    for n, body in (("a.json", "A"), ("x/b.json", "B")):
        (tmp_path / n).write_text(body)
    got = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256) for r in files.file_hashes(spark, str(tmp_path), "*.json").collect()}
    assert got == {n: (1, hashlib.sha256(b).hexdigest()) for n, b in (("a.json", b"A"), ("b.json", b"B"))}
    assert len(files.combined_hash(files.file_hashes(spark, str(tmp_path))).first().sha256) == 64
    assert files.one_file(spark, str(tmp_path), "b.json").endswith("x/b.json")
    with pytest.raises(LookupError):
        files.one_file(spark, str(tmp_path), "*.json")
    (tmp_path / "base").write_text(json.dumps({"b": " two ", "a": "one"}))
    assert [tuple(r) for r in files.baseline(spark, str(tmp_path / "base")).collect()] == [("a", "one"), ("b", "two")]
    row = spark.range(1).select(files.text_leaves(F.lit('{"a": ["x", {"b": "y"}, 1], "c": "z"}')).alias("t")).first()
    assert row.t == ["x", "y", "z"]


def test_packet_documents(spark, tmp_path):
    doc = lambda i, ids: {"packet_id": i, "artifact_id": "a", "event_ids": ids, "events": [{"event_id": e} for e in ids]}
    for i, ids in (("p1", ["e1", "e2"]), ("p2", ["e3"]), ("p9", [])):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc(i, ids)))
    manifest = spark.createDataFrame([("p1", "a", ["e1", "e2"]), ("p2", "a", ["other"]), ("p3", "a", [])], "packet_id string, artifact_id string, event_ids array<string>")
    good, bad = files.packet_documents(spark, str(tmp_path), manifest)
    assert [r.packet_id for r in good.collect()] == ["p1"] and sorted(r.packet_id for r in bad.collect()) == ["p2", "p3"]
