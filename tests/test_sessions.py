"""JSON-lines sources of our own making: accounting, window, identity, events."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from siftline.operators import sessions
from siftline.sources import jsonl

START, CUTOFF = "2026-08-16T20:00:00Z", "2026-08-24T14:00:00Z"


def write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


@pytest.fixture
def census(spark, tmp_path):
    codex, claude = tmp_path / "codex", tmp_path / "claude"
    at = "2026-08-18T13:00:0{}Z".format
    meta = lambda i, **p: {"timestamp": at(0), "type": "session_meta", "payload": {"id": i, "session_id": "box", **p}}
    say = lambda role, text, k: {"timestamp": at(k), "type": "response_item", "payload": {"type": "message", "role": role, "content": [{"type": "input_text", "text": text}]}}
    write(codex / "root.jsonl", [meta("root"), say("user", "hello", 1), say("assistant", "fine", 2), {"timestamp": at(3), "type": "response_item", "payload": {"type": "function_call", "arguments": "{}", "call_id": "1"}}, {"timestamp": at(4), "type": "response_item", "payload": {"type": "function_call_output", "output": "42"}}])
    write(codex / "sub" / "child.jsonl", [meta("child", parent_thread_id="root", cwd="/x/tests/y"), say("user", "again", 1)])
    write(codex / "late.jsonl", [{**meta("late"), "timestamp": CUTOFF}])
    write(codex / "bad.jsonl", [meta("bad"), '{"open": ', "", '{"a": 1} x'])
    write(claude / "c.jsonl", [{"type": "user", "sessionId": "s1", "timestamp": at(1), "entrypoint": "cli", "isSidechain": False, "message": {"role": "user", "content": "hi\rthere"}}, {"type": "assistant", "sessionId": "s1", "timestamp": at(2), "message": {"role": "assistant", "content": [{"type": "text", "text": "yes"}, {"type": "tool_use", "id": "t", "input": {"q": 1}}]}}, {"type": "user", "sessionId": "s1", "message": {"content": "no time"}}])
    write(claude / "two.jsonl", [{"type": "user", "sessionId": "s2", "timestamp": at(1), "message": {"content": "a"}}, {"type": "user", "sessionId": "s3", "timestamp": at(1), "message": {"content": "b"}}])
    (claude / "note.txt").write_text("{}\n")
    roots = {"codex": str(codex), "claude": str(claude)}
    lines = jsonl.read_lines(spark, roots)
    rows = sessions.records(lines, roots, F.lit(START).cast("timestamp"), F.lit(CUTOFF).cast("timestamp")).cache()
    by_id = {r.artifact_id: r for r in sessions.artifact_census(rows).collect()}
    names = {"root": "codex\0root.jsonl", "child": "codex\0sub/child.jsonl", "late": "codex\0late.jsonl", "bad": "codex\0bad.jsonl", "s1": "claude\0c.jsonl", "two": "claude\0two.jsonl"}
    found = {k: by_id.pop("artifact-" + hashlib.sha256(v.encode()).hexdigest()[:24]) for k, v in names.items()}
    assert not by_id
    return rows, found, roots


def test_status(census):
    _, found, _ = census
    fine = ("complete", None)
    assert {k: (r.status, r.reason) for k, r in found.items()} == {"root": fine, "child": fine, "s1": fine, "two": fine, "late": ("excluded", "no_in_window_events"), "bad": ("quarantined", "malformed_jsonl")}
    assert found["bad"].malformed_lines == 2 and found["bad"].blank_lines == 1
    assert found["s1"].missing_timestamps == 1 and found["s1"].events == 2


def test_identity(census):
    _, found, _ = census
    assert found["child"].parent_id == found["root"].artifact_id
    assert found["child"].source_kind == "child_agent" and found["child"].directory == "synthetic_test"
    assert found["s1"].shape == "interactive" and found["s1"].source_kind == "root_conversation"
    assert found["root"].container_id == "box"
    assert found["two"].session_id == "?" and found["two"].conflicting_ids
    assert found["late"].session_id == "?" and not found["late"].conflicting_ids


def test_events(spark, census):
    rows, found, _ = census
    events = sessions.normalized_events(rows).collect()
    by = lambda a: [(e.role, e.strength, e.text) for e in sorted(events, key=lambda e: (e.ordinal, e.part)) if e.artifact_id == found[a].artifact_id]
    assert by("root") == [("user", "asserted", "hello"), ("assistant", "reasoned", "fine"), ("tool", "reasoned", "{}"), ("tool_result", "observed", "42")]
    assert by("s1") == [("user", "asserted", "hi\rthere"), ("assistant", "reasoned", "yes"), ("tool", "reasoned", '{"q":1}')]


def test_content_hash_is_of_canonical_lines(census):
    _, found, roots = census
    with open(os.path.join(roots["codex"], "root.jsonl")) as f:
        want = hashlib.sha256("".join(jsonl.canonical_json(json.loads(x)) + "\n" for x in f).encode()).hexdigest()
    assert found["root"].content_sha256 == want


def test_discovery(tmp_path):
    root = tmp_path / "r"
    write(root / "b.jsonl", [])
    write(root / "a" / "x.jsonl", [])
    os.symlink(root / "b.jsonl", root / "link.jsonl")
    os.mkfifo(root / "pipe.jsonl")
    got = jsonl.discover({"h": str(root)})
    assert [os.path.relpath(p, root) for _, p in got.files] == ["a/x.jsonl", "b.jsonl"]
    assert sorted(r[2] for r in got.refused) == ["special_file_rejected", "symlink_rejected"]
    with pytest.raises(ValueError):
        os.symlink(root, tmp_path / "rl")
        jsonl.discover({"h": str(tmp_path / "rl")})


def test_every_file_is_accounted_for(spark, tmp_path):
    """Empty, refused and changed files have their rows; ids, parents and late records of all kinds count."""
    root = tmp_path / "claude"
    at = "2026-08-18T13:00:0{}Z".format
    say = lambda k, **x: {"type": "user", "timestamp": at(k), "sessionId": "s1", **x}
    write(root / "a.jsonl", [say(1, parentUuid="p", session_id="s9"), say(2, payload={"parent_uuid": "q", "forkedFrom": 7}), {**say(3, sessionId="late"), "timestamp": CUTOFF}, {**say(4), "timestamp": "1700000000"}, {**say(5), "timestamp": True}])
    (root / "empty.jsonl").write_text("")
    (root / "big.jsonl").write_text('{"type": "user", "x": "' + "y" * (2 * 1024 * 1024) + '"}\n' + json.dumps(say(1)) + "\n")
    os.symlink(root / "a.jsonl", root / "link.jsonl")
    roots = {"claude": str(root)}
    found = jsonl.discover(roots)
    rows = sessions.records(jsonl.read_lines(spark, {"claude": [p for _, p in found.files]}), roots, F.lit(START).cast("timestamp"), F.lit(CUTOFF).cast("timestamp")).cache()
    assert found.changes() == {}
    with open(root / "empty.jsonl", "a") as f:
        f.write("\n")
    changed = found.changes()
    assert list(changed.values()) == ["source_changed_during_read"]
    listed = found.artifacts(spark, changed).select(sessions.artifact_key(F.col("harness"), F.col("path"), roots).alias("artifact_id"), "harness", "fault")
    key = lambda n: "artifact-" + hashlib.sha256(f"claude\0{n}.jsonl".encode()).hexdigest()[:24]
    got = {r.artifact_id: r for r in sessions.artifact_census(rows, listed).collect()}
    assert set(got) == {key(n) for n in ("a", "empty", "big", "link")}
    assert [(got[key(n)].status, got[key(n)].reason) for n in ("empty", "big", "link")] == [("quarantined", "source_changed_during_read"), ("quarantined", "record_too_large"), ("quarantined", "symlink_rejected")]
    a = got[key("a")]
    assert (a.status, a.events, a.invalid_timestamps, a.supplemental_ids, a.post_cutoff_conflicts, a.parent_ref, a.session_id) == ("complete", 2, 2, 1, 1, "?", "s1")
    assert got[key("big")].oversized_lines == 1 and got[key("empty")].total_lines == 0


def test_line_numbers_of_split_files(spark, tmp_path):
    """Lines of files read in many blocks are numbered as in the file."""
    n = 4000
    write(tmp_path / "r" / "x.jsonl", [{"k": i} for i in range(n)])
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r.line_no: json.loads(r.canonical)["k"] for r in jsonl.read_lines(spark, {"claude": str(tmp_path / "r")}).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert got == {i: i for i in range(n)}
