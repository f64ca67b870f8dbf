"""Normalisation as a whole: in-window records to dispositions, events and packets.

One Arrow pass over the records (no grouping) takes the texts out of the many
record shapes and inspects them; all that follows is relational: which wrapped
items were seen before, the first fault of each artifact, what became of each
record, and packets of the artifacts without a fault.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions import blocks, ids, text
from siftline.functions import lexicons as L
from siftline.operators import census, packing
from siftline.sources import scratch
from siftline.sources.jsonl import canonical_json

ITEM = "struct<part:int,role:string,strength:string,item:string,wrapped:boolean,reason:string,text:string>"
INSPECTED = f"artifact_id string, harness string, ordinal int, ts timestamp, type string, leaf_reason string, excluded int, fingerprints array<string>, items array<{ITEM}>"
_SPEAKERS = ("user", "assistant", "system", "developer")


def said(value) -> str:
    """The text of a content value: strings, text fields, nested contents, lists of them; other objects as JSON."""
    if value is None:
        return ""
    if isinstance(value, dict):
        if isinstance(value.get("text"), str):
            return value["text"]
        return said(value["content"]) if "content" in value else canonical_json(value)
    if isinstance(value, list):
        return "\n".join(filter(None, map(said, value)))
    return value if isinstance(value, str) else str(value)


def leaves(value) -> Iterator[str]:
    """All strings of a JSON value, depth first."""
    if isinstance(value, str):
        yield value
    elif isinstance(value, (dict, list)):
        for child in value.values() if isinstance(value, dict) else value:
            yield from leaves(child)


def provenance(harness: str, record: dict) -> str:
    """The shape of a record, which decides whether it may carry a registered block."""
    kind = str(record.get("type", "unknown"))
    if harness != "codex":
        return f"{harness}:{kind}"
    inner = record.get("payload")
    return f"codex:{kind}:{inner.get('type', '?') if isinstance(inner, dict) else '?'}"


def _strength(role: str) -> str:
    return {"user": "asserted", "tool_result": "observed"}.get(role, "reasoned")


def claude_items(record: dict) -> Iterator[tuple[str, int, str | None, bool, str]]:
    """(role, part, item id, wrapped, text) of a claude record."""
    kind, message = record.get("type"), record.get("message")
    if kind == "system":
        yield "system", 1, None, False, said(record.get("content"))
    if kind not in ("user", "assistant") or not isinstance(message, dict) or message.get("role") not in _SPEAKERS:
        return
    role, content = message["role"], message.get("content")
    if isinstance(content, str):
        yield role, 1, None, False, content
    for part, block in enumerate(content if isinstance(content, list) else [], 1):
        if not isinstance(block, dict):
            continue
        match block.get("type"):
            case "text":
                yield role, part, None, False, said(block.get("text"))
            case "tool_use":
                yield "tool", part, str(block.get("id", "")) or None, False, said(block.get("input"))
            case "tool_result":
                yield "tool_result", part, str(block.get("tool_use_id", "")) or None, False, said(block.get("content"))


def _first(holder: dict, *keys: str):
    """The value of the first of these keys that is there."""
    return next((holder[k] for k in keys if k in holder), None)


def codex_items(record: dict) -> Iterator[tuple[str, int, str | None, bool, str]]:
    """(role, part, item id, wrapped, text) of a codex response item; wrapped ones count only if their id is new."""
    inner = record.get("payload")
    if record.get("type") != "response_item" or not isinstance(inner, dict):
        return
    kind, wrapped = inner.get("type"), False
    if kind == "item_completed":
        inner, wrapped = inner.get("item"), True
        if not isinstance(inner, dict):
            return
        kind = inner.get("type")
    own = inner.get("id")
    item = str(own) if isinstance(own, (str, int)) else None
    if wrapped:
        role = {"UserMessage": "user", "AgentMessage": "assistant", "CommandExecution": "tool_result", "McpToolCall": "tool_result"}.get(kind)
        value = _first(inner, "aggregated_output", "result", "stdout") if role == "tool_result" else inner.get("content")
    else:
        role = inner.get("role") if kind == "message" and inner.get("role") in _SPEAKERS else None
        value = inner.get("content")
        match kind:
            case "user_message":
                role, value = "user", _first(inner, "message", "text_elements")
            case "agent_message":
                role = "assistant"
            case "function_call" | "custom_tool_call":
                role, value = "tool", _first(inner, "arguments", "input")
            case "function_call_output" | "custom_tool_call_output":
                role, value = "tool_result", inner.get("output")
    if role:
        yield role, 1, item, wrapped, said(value)


def inspected(rows: DataFrame, rules: Sequence[blocks.Rule]) -> DataFrame:
    """In-window rows (sessions.records) with their ordinal, inspected leaves and items."""
    order = Window.partitionBy("artifact_id").orderBy("line_no")
    inside = rows.filter("inside").select("artifact_id", "harness", F.row_number().over(order).alias("ordinal"), "ts", F.coalesce("type", F.lit("unknown")).alias("type"), "canonical")
    inspect = blocks.Inspector(rules)

    def look(harness: str, canonical: str) -> tuple:
        record = json.loads(canonical)
        shape, cut = provenance(harness, record), []
        for leaf in leaves(record):
            found = inspect(leaf, shape)
            cut += found.fingerprints
            if found.reason:
                return found.reason, len(cut), sorted(set(cut)), []
        items = []
        for role, part, item, wrapped, value in (codex_items if harness == "codex" else claude_items)(record):
            if value:
                found = inspect(value, shape)
                items.append({"part": part, "role": role, "strength": _strength(role), "item": item, "wrapped": wrapped, "reason": found.reason, "text": found.remaining})
        return None, len(cut), sorted(set(cut)), items

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [look(h, c) for h, c in zip(pdf["harness"], pdf["canonical"], strict=True)]
            names = ("leaf_reason", "excluded", "fingerprints", "items")
            yield pdf.drop(columns="canonical").assign(**{n: pd.Series([g[i] for g in got], index=pdf.index, dtype=object) for i, n in enumerate(names)})

    return inside.mapInPandas(run, INSPECTED)


@dataclass
class Normalized:
    """outcomes: a row an artifact.  coverage: a row a record.  events and packets: of complete artifacts."""

    outcomes: DataFrame
    coverage: DataFrame
    events: DataFrame
    packets: DataFrame
    provenance: DataFrame


def checked_items(records: DataFrame, version: DataFrame) -> DataFrame:
    """Items of inspected records as events, each with the first check that it fails."""
    flat = records.filter("leaf_reason IS NULL").select("artifact_id", "harness", "ordinal", "ts", F.posexplode("items").alias("place", "i")).select("artifact_id", "harness", "ordinal", "ts", "place", "i.*")
    # an item that wraps what the artifact has shown before is not an event
    seen = F.row_number().over(Window.partitionBy("artifact_id", F.coalesce("item", F.concat_ws(":", "ordinal", "place"))).orderBy("ordinal", "place"))
    flat = flat.withColumn("nth", F.when((F.col("harness") == "codex") & F.col("item").isNotNull(), seen).otherwise(1)).filter("NOT wrapped OR nth = 1").drop("nth")
    blank = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")) == ""
    flat = flat.join(version, "artifact_id").filter(F.col("reason").isNotNull() | ~blank)
    flat = flat.withColumn("__r", text.redacted(F.col("text"))).withColumn("redacted", text.escape_markup(F.col("__r.text"))).withColumn("redactions", F.col("__r.count")).drop("__r")
    flat = flat.withColumn("event_id", ids.stable_id("event-", F.col("artifact_id"), F.col("version"), F.col("ordinal"), F.col("part"), F.col("role")))
    flat = flat.withColumn("evidence_uri", ids.evidence_uri(F.col("harness"), F.col("artifact_id"), F.col("version"), F.col("event_id")))
    micros = F.when(F.unix_micros("ts") % 1_000_000 != 0, F.date_format("ts", ".SSSSSS")).otherwise("")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), micros, F.lit("Z"))
    body = F.struct(F.col("event_id"), F.col("strength").alias("evidence_strength"), F.col("evidence_uri"), F.col("ordinal"), F.col("role"), F.col("redacted").alias("text"), stamp.alias("timestamp"))
    flat = flat.withColumn("event", F.to_json(body))
    secret = (F.size(text.credential_ids(F.col("text"))) > 0) | text.high_entropy_secret()("text")
    reason = F.coalesce(
        "reason",
        F.when(F.col("role").isin("system", "developer", "hook"), "unknown_injected_context"),
        F.when(secret, "credential_detected"),
        F.when(F.octet_length("event") > L.MAX_EVENT_BYTES, "event_too_large"),
    )
    return flat.withColumn("reason", reason)


def pack(events: DataFrame, max_bytes: int, max_tokens: int) -> DataFrame:
    """Packets of events in order, with the reason that one of them is refused after serialisation."""
    frame = {"artifact_id": 33, "event_ids": 2, "events": 2, "fingerprint_policy_version": 2 + len(L.FINGERPRINT_POLICY), "harness": 0, "packet_id": 33, "redaction_policy_version": 2 + len(L.REDACTION_POLICY), "schema_version": 2 + len(L.PACKET_SCHEMA), "source_version": 66}
    envelope = 2 + sum(len(k) + 3 + v for k, v in frame.items()) + len(frame) - 1 + len('"claude"')
    limit = min(max_bytes, max_tokens * L.BYTES_PER_TOKEN) - envelope + 2  # the last event and id have no comma
    size = F.octet_length("event") + F.octet_length("event_id") + 4
    packed = packing.greedy(events, ["artifact_id"], ["ordinal", "place"], size, limit, ["version", "harness", "event_id", "event"])
    rows = F.array_sort(F.collect_list(F.struct("ordinal", "place", "event_id", "event")))
    by = packed.groupBy("artifact_id", "version", "harness", "packet").agg(rows.alias("rows"), (F.sum("size") + envelope - 2).alias("bytes"), F.bool_or("overflow").alias("over"))
    by = by.withColumn("event_ids", F.transform("rows", lambda r: r["event_id"])).withColumn("events", F.transform("rows", lambda r: r["event"])).drop("rows")
    key = F.concat(F.lit('{"artifact_id":"'), F.col("artifact_id"), F.lit('","event_ids":["'), F.array_join("event_ids", '","'), F.lit('"],"source_version":"'), F.col("version"), F.lit('"}'))
    body = F.array_join("events", ",")
    secret = (F.size(text.credential_ids(body)) > 0) | text.high_entropy_secret()(body)
    reason = F.when(F.col("over"), "packet_too_large").when(secret, "post_serialization_redaction_quarantine").when(text.has_markup(body), "post_serialization_unsafe_content")
    return by.select(F.concat(F.lit("packet-"), F.substring(F.sha2(key, 256), 1, 24)).alias("packet_id"), "artifact_id", "harness", "packet", "event_ids", "events", "bytes", F.floor((F.col("bytes") + 2) / 3).cast("long").alias("tokens"), reason.alias("reason"))


def normalize(rows: DataFrame, manifest: DataFrame, rules: Sequence[blocks.Rule] = (), max_bytes: int = L.MAX_PACKET_BYTES, max_tokens: int = L.MAX_PACKET_TOKENS) -> Normalized:
    """Normalise the artifacts of a manifest (artifact_id, harness, status, reason, events, content_sha256) from rows (sessions.records).

    What the census did not complete keeps its status; an artifact that is not in
    the source, or differs from the manifest, is quarantined, and so is one with
    any record that fails a check: the first in order gives the reason.
    """
    base = scratch.folder(rows.sparkSession, "normalized")
    complete = manifest.filter("status = 'complete'")
    version = complete.select("artifact_id", F.col("content_sha256").alias("version"))
    own = rows.join(version.select("artifact_id"), "artifact_id", "left_semi")
    records = scratch.stored(inspected(own, rules), f"{base}/records")
    source = own.groupBy("artifact_id").agg(F.count_if("inside").alias("found"), F.min(F.when(F.col("state") == "oversized", F.struct("line_no", F.lit("record_too_large").alias("r"))).when(F.col("state") == "malformed", F.struct("line_no", F.lit("malformed_jsonl").alias("r"))))["r"].alias("bad"))
    source = source.join(census.content_hash(own.filter("inside"), ["artifact_id"], ["line_no"], F.col("canonical")), "artifact_id", "left")
    read = complete.select("artifact_id", "events", F.col("content_sha256").alias("told")).join(source, "artifact_id", "left")
    differs = (F.col("found") != F.col("events")) | ~F.coalesce(F.col("content_sha256") == F.col("told"), F.lit(False))
    read = scratch.stored(read.select("artifact_id", "found", F.when(F.col("found").isNull(), "source_manifest_resolution_failed").when(F.col("bad").isNotNull(), F.col("bad")).when(differs, "manifest_source_mismatch").alias("read_reason")), f"{base}/read")

    items = scratch.stored(checked_items(records, version), f"{base}/items")
    at_leaf = records.filter("leaf_reason IS NOT NULL").select("artifact_id", F.struct("ordinal", F.lit(-1).alias("place"), F.col("leaf_reason").alias("reason")).alias("fault"))
    at_item = items.filter("reason IS NOT NULL").select("artifact_id", F.struct("ordinal", "place", "reason").alias("fault"))
    faults = scratch.stored(at_leaf.unionByName(at_item).groupBy("artifact_id").agg(F.min("fault").alias("fault")), f"{base}/faults")
    sound = read.filter("read_reason IS NULL").select("artifact_id").join(faults.select("artifact_id"), "artifact_id", "left_anti")
    built = scratch.stored(pack(items.join(sound, "artifact_id", "left_semi"), max_bytes, max_tokens), f"{base}/built")
    refused = built.filter("reason IS NOT NULL").groupBy("artifact_id").agg(F.min_by("reason", "packet").alias("packet_reason"))
    packets = built.join(refused.select("artifact_id"), "artifact_id", "left_anti").drop("reason")

    stopped = F.col("fault.ordinal")
    told = records.join(faults, "artifact_id", "left").join(read.filter("read_reason IS NULL").select("artifact_id"), "artifact_id", "left_semi").filter(stopped.isNull() | (F.col("ordinal") <= stopped))
    sums = told.groupBy("artifact_id").agg(F.sum("excluded").alias("excluded_blocks"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("fingerprints")))).alias("fingerprints"))
    kept = items.join(faults, "artifact_id", "left").filter(stopped.isNull() | (F.struct("ordinal", "place") < F.struct(stopped, F.col("fault.place"))))
    redactions = kept.groupBy("artifact_id").agg(F.sum("redactions").alias("redactions"), F.count(F.lit(1)).alias("normalized"))
    numbers = packets.groupBy("artifact_id").agg(F.count(F.lit(1)).alias("packets"), F.sum("bytes").alias("packet_bytes"))
    out = manifest.select("artifact_id", "harness", F.col("status").alias("upstream"), F.col("reason").alias("upstream_reason"), F.col("events").alias("expected"))
    for part in (read, faults, refused, sums, redactions, numbers):
        out = out.join(part, "artifact_id", "left")
    reason = F.coalesce("read_reason", "fault.reason", "packet_reason")
    known = F.col("upstream").isin("excluded", "quarantined", "failed")
    status = F.when(F.col("upstream") != "complete", F.when(known, F.col("upstream")).otherwise("failed")).when(reason.isNotNull(), "quarantined").otherwise("complete")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    good = status == "complete"
    read_on = F.when(F.col("upstream") != "complete", F.col("expected")).otherwise(F.coalesce(stopped.cast("long"), "found", "expected"))
    outcomes = scratch.stored(out.select(
        "artifact_id", "harness", status.alias("status"), F.when(F.col("upstream") != "complete", F.coalesce("upstream_reason", F.lit("upstream_terminal_status"))).otherwise(reason).alias("reason"),
        read_on.alias("source_events"), F.when(good, zero("normalized")).otherwise(0).alias("events"), F.when(good, zero("packets")).otherwise(0).alias("packets"), zero("packet_bytes").alias("packet_bytes"), zero("redactions").alias("redactions"),
        zero("excluded_blocks").alias("excluded_blocks"), F.coalesce("fingerprints", F.array().cast("array<string>")).alias("fingerprints"),
    ), f"{base}/outcomes")

    by_record = kept.filter("reason IS NULL").groupBy("artifact_id", "ordinal").agg(F.array_sort(F.collect_list(F.struct("place", "event_id"))).alias("e")).select("artifact_id", "ordinal", F.transform("e", lambda x: x["event_id"]).alias("event_ids"))
    cover = told.select("artifact_id", "ordinal", "excluded", "fault").join(by_record, ["artifact_id", "ordinal"], "left")
    at_fault = F.coalesce(F.col("ordinal") == stopped, F.lit(False))
    what = F.when(at_fault, "quarantined").when(F.col("event_ids").isNotNull(), "packet").when(F.col("excluded") > 0, "excluded_injected_context").otherwise("unsupported_record")
    why = F.when(at_fault, F.col("fault.reason")).when(F.col("event_ids").isNotNull(), ids.UNKNOWN).when(F.col("excluded") > 0, "injected_context_removed").otherwise("no_supported_text")
    source_id = ids.stable_id("source-event-", F.col("artifact_id"), F.col("version"), F.lit("source"), F.col("ordinal"))
    held = F.when(at_fault, F.array().cast("array<string>")).otherwise(F.coalesce("event_ids", F.array().cast("array<string>")))
    coverage = cover.join(version, "artifact_id").select("artifact_id", source_id.alias("source_event_id"), "ordinal", what.alias("disposition"), why.alias("reason"), held.alias("event_ids"))
    finished = outcomes.filter("status = 'complete'").select("artifact_id")
    shapes = told.filter("excluded > 0").groupBy("artifact_id", "type").agg(F.sum("excluded").alias("blocks"))
    return Normalized(outcomes, coverage, items.join(finished, "artifact_id", "left_semi").drop("reason"), packets, shapes)


def summary(done: Normalized) -> DataFrame:
    """One row: artifacts by status (zero-filled), events, packets, bytes, redactions, blocks cut out and how many different."""
    totals = {"events": "events", "packets": "packets", "packet_bytes": "packet_bytes", "redactions": "redactions", "injected_excluded_blocks": "excluded_blocks"}
    different = F.size(F.array_distinct(F.flatten(F.collect_set("fingerprints"))))  # at most as many as the rules have digests
    return done.outcomes.agg(
        F.count(F.lit(1)).alias("artifacts"), *(F.count_if(F.col("status") == s).alias(s) for s in L.TERMINAL_STATUSES), *(F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in totals.items()), different.alias("injected_fingerprints")
    )


def reasons(done: Normalized) -> DataFrame:
    """How many artifacts ended for each reason."""
    return done.outcomes.filter("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("artifacts"))


def covered(done: Normalized) -> DataFrame:
    """artifact_id, whole: every event of a complete artifact is in one packet once, and in the coverage once."""
    events = done.events.select("artifact_id", "event_id", F.lit(1).alias("e"), F.lit(0).alias("p"), F.lit(0).alias("c"))
    packed = done.packets.select("artifact_id", F.explode("event_ids").alias("event_id"), F.lit(0).alias("e"), F.lit(1).alias("p"), F.lit(0).alias("c"))
    told = done.coverage.select("artifact_id", F.explode("event_ids").alias("event_id"), F.lit(0).alias("e"), F.lit(0).alias("p"), F.lit(1).alias("c"))
    finished = done.outcomes.filter("status = 'complete'").select("artifact_id")
    n = events.unionByName(packed).unionByName(told).groupBy("artifact_id", "event_id").agg(*(F.sum(c).alias(c) for c in "epc"))
    once = n.groupBy("artifact_id").agg(F.bool_and(F.expr("e = 1 AND p = 1 AND c = 1")).alias("whole"))
    return finished.join(once, "artifact_id", "left").select("artifact_id", F.coalesce("whole", F.lit(True)).alias("whole"))
