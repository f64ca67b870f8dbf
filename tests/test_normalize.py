"""Record shapes, blocks, schemas and the order of checks, on small cases."""

import json

import pytest
from pyspark.sql import functions as F

from siftline.functions import blocks, schema
from siftline.operators import normalize, sessions
from siftline.sources import jsonl


@pytest.mark.parametrize(("value", "text"), [("a", "a"), (None, ""), (5, "5"), (True, "True"), ({"text": "t", "x": 1}, "t"), ({"content": ["a", "", {"text": "b"}]}, "a\nb"), ({"q": 1, "a": "é"}, '{"a":"é","q":1}'), ([], "")])
def test_said(value, text):
    assert normalize.said(value) == text


def codex(**inner):
    return [x[:1] + x[2:] for x in normalize.codex_items({"type": "response_item", "payload": inner})]


def test_codex_items():
    assert codex(type="message", role="user", content=[{"text": "a"}], id="1") == [("user", "1", False, "a")]
    assert codex(type="message", role="critic", content="a") == [] and codex(type="reasoning", content="a") == [] and codex(type=3) == []
    assert codex(type="user_message", text_elements=["x", "y"]) == [("user", None, False, "x\ny")]
    assert codex(type="agent_message", content="x", id=7) == [("assistant", "7", False, "x")]
    assert codex(type="custom_tool_call", input={"a": 1}) == [("tool", None, False, '{"a":1}')]
    assert codex(type="custom_tool_call_output", output="o") == [("tool_result", None, False, "o")]
    for kind, role, field in (("UserMessage", "user", "content"), ("AgentMessage", "assistant", "content"), ("CommandExecution", "tool_result", "stdout"), ("McpToolCall", "tool_result", "result")):
        assert codex(type="item_completed", item={"type": kind, "id": "9", field: "z"}) == [(role, "9", True, "z")]
    assert codex(type="item_completed", item="no") == [] and codex(type="item_completed", item={"type": "message", "role": "user", "content": "x"}) == []
    assert list(normalize.codex_items({"type": "event_msg", "payload": {"type": "message", "role": "user", "content": "a"}})) == []


def test_claude_items():
    items = lambda **r: list(normalize.claude_items(r))
    assert items(type="system", content="s") == [("system", 1, None, False, "s")]
    parts = [{"type": "text", "text": "a"}, "odd", {"type": "tool_use", "id": "t", "input": {"q": 1}}, {"type": "tool_result", "tool_use_id": "t", "content": [{"text": "r"}]}, {"type": "image"}]
    assert items(type="user", message={"role": "user", "content": parts}) == [("user", 1, None, False, "a"), ("tool", 3, "t", False, '{"q":1}'), ("tool_result", 4, "t", False, "r")]
    assert items(type="user", message={"role": "critic", "content": "x"}) == [] and items(type="user", message="x") == [] and items(type="mode", message={"role": "user", "content": "x"}) == []


def test_blocks():
    block = "<b>one two</b>"
    look = blocks.Inspector([blocks.Rule("<b>", "</b>", frozenset([blocks.fingerprint("<b>one  two</b>")]), frozenset(["claude:user"]))])
    assert look(f"x{block}y{block}", "claude:user") == blocks.Inspection(None, "xy", (blocks.fingerprint(block),) * 2)
    assert look(block, "codex:event_msg:?").reason == "unknown_injected_context" and look("<b>two</b>", "claude:user").reason == "unknown_injected_context"
    assert look(block + "<b>", "claude:user").reason == "unresolved_injected_context" and look("<system>").reason == "unknown_injected_context"
    assert normalize.provenance("codex", {"type": "event_msg", "payload": {"type": "x"}}) == "codex:event_msg:x" and normalize.provenance("codex", {}) == "codex:unknown:?"


@pytest.mark.parametrize(
    ("value", "rules", "errors"),
    [
        (5, {"type": ["string", "integer"]}, []), (True, {"type": "integer"}, ["$:expected_integer"]), (1.5, {"type": "number"}, []), ("a", {"type": "odd"}, ["$:expected_odd"]),
        ("ab", {"pattern": "a"}, ["$:pattern"]), (0, {"minimum": 1, "enum": [0]}, ["$:minimum"]), (2, {"enum": [1], "const": 3}, ["$:enum", "$:const"]),
        ({}, {"minProperties": 1, "required": ["a"]}, ["$:minProperties", "$.a:required"]), ({"b": 1}, {"additionalProperties": False}, ["$.b:unexpected"]),
        ([{"a": 1}, {"a": 1}, 3], {"uniqueItems": True, "minItems": 4, "items": {"type": "object"}}, ["$:minItems", "$:uniqueItems", "$[2]:expected_object"]),
        ({"a": {"b": "x"}}, {"properties": {"a": {"$ref": "#/$defs/c~1d"}}, "$defs": {"c/d": {"properties": {"b": {"type": "integer"}}}}}, ["$.a.b:expected_integer"]),
        (1, {"$ref": "other"}, ["$:unsupported_ref"]), (1, {"$ref": "#/x"}, ["$:unresolved_ref"]), (1, {"$ref": "#/x", "x": 3}, ["$:invalid_ref"]),
    ],
)
def test_schema(value, rules, errors):
    assert schema.Schema(rules).errors(value) == errors


def _rows(spark, records):
    lines = [("codex", "/r/a.jsonl", i, json.dumps({"timestamp": f"2026-01-01T00:00:{i:02d}Z", **r})) for i, r in enumerate(records)]
    df = spark.createDataFrame(lines, "harness string, path string, line_no long, raw string").withColumn("bytes", F.octet_length("raw").cast("long"))
    at = lambda t: F.lit(t).cast("timestamp")
    return sessions.records(jsonl.parse_lines(df), {"codex": "/r"}, at("2026-01-01T00:00:00Z"), at("2026-01-02T00:00:00Z"))


def test_wrapped_items_count_once(spark):
    item = lambda i, t, **x: {"type": "response_item", "payload": {"type": "item_completed", "item": {"type": "AgentMessage", "id": i, "content": t, **x}}}
    plain = lambda i, t: {"type": "response_item", "payload": {"type": "message", "role": "assistant", "id": i, "content": t}}
    rows = _rows(spark, [plain("1", "a"), item("1", "a"), item("2", "b"), item("2", "b"), plain("2", "c"), item("3", ""), item("3", "d"), {"type": "turn_context"}])
    done = normalize.normalize(rows, sessions.artifact_census(rows))
    got = sorted((r.ordinal, json.loads(r.event)["text"]) for r in done.events.collect())
    assert got == [(1, "a"), (3, "b"), (5, "c"), (7, "d")]
    (o,) = done.outcomes.collect()
    assert (o.status, o.reason, o.source_events, o.events, o.packets) == ("complete", None, 8, 4, 1)
    assert [r.disposition for r in sorted(done.coverage.collect(), key=lambda r: r.ordinal)] == ["packet", "unsupported_record", "packet", "unsupported_record", "packet", "unsupported_record", "packet", "unsupported_record"]
    (p,) = done.packets.collect()
    whole = {"artifact_id": p.artifact_id, "event_ids": p.event_ids, "events": [json.loads(e) for e in p.events], "fingerprint_policy_version": "injected-context-v3", "harness": "codex", "packet_id": p.packet_id, "redaction_policy_version": "redaction-v1", "schema_version": "session-packet/v1", "source_version": o and sessions.artifact_census(rows).first().content_sha256}
    assert abs(len(jsonl.canonical_json(whole).encode()) - p.bytes) <= 1
    assert normalize.covered(done).first().whole


def test_packets_are_runs_in_order(spark):
    say = lambda t: {"type": "response_item", "payload": {"type": "message", "role": "user", "content": t}}
    rows = _rows(spark, [say("word " * 300) for _ in range(12)])
    done = normalize.normalize(rows, sessions.artifact_census(rows), max_bytes=6000)
    events = [r.event_id for r in sorted(done.events.collect(), key=lambda r: r.ordinal)]
    packets = sorted(done.packets.collect(), key=lambda p: p.packet)
    assert [e for p in packets for e in p.event_ids] == events and all(p.bytes <= 6000 for p in packets) and len(packets) == 4
    assert normalize.normalize(rows, sessions.artifact_census(rows), max_bytes=1500).outcomes.first().reason == "packet_too_large"


def test_greedy_packing_of_a_large_group_is_linear(spark):
    from siftline.operators import packing

    n = 100_000
    df = spark.range(n).select(F.lit(1).alias("g"), "id", (F.col("id") % 7 + 1).alias("s"))
    got = packing.greedy(df, ["g"], ["id"], F.col("s"), 100).groupBy("packet").agg(F.sum("size").alias("n"), F.min("id").alias("first"), F.max("id").alias("last")).orderBy("packet").collect()
    assert all(r.n <= 100 for r in got) and [r.first for r in got[1:]] == [r.last + 1 for r in got[:-1]] and got[-1].last == n - 1
    assert all(a.n + (b.first % 7 + 1) > 100 for a, b in zip(got, got[1:]))
