"""From JSON lines to a census of session artifacts and their normalised events.

Records come as canonical JSON by artifact and line.  The census counts,
windows, hashes and resolves identity with aggregates; events explode the
records' content blocks.  Joins and windows are by artifact, so any number of
artifacts runs in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions import ids
from siftline.functions import lexicons as L
from siftline.operators import census
from siftline.sources import scratch


def artifact_key(harness: Column, path: Column, roots: dict[str, str]) -> Column:
    """The id of an artifact: its harness and its path below the root."""
    relative = F.lit(None).cast("string")
    for name, root in roots.items():
        relative = F.when(harness == name, F.substring_index(path, f"{root.rstrip('/')}/", -1)).otherwise(relative)
    return ids.stable_id("artifact-", harness, relative)


def records(lines: DataFrame, roots: dict[str, str], start: Column, cutoff: Column) -> DataFrame:
    """Lines (jsonl.LINES) with artifact_id and their place in the window."""
    ts = F.col("ts")
    rows = lines.withColumn("artifact_id", artifact_key(F.col("harness"), F.col("path"), roots))
    return rows.withColumn("inside", census.in_window(ts, start, cutoff)).withColumn("before_cutoff", F.coalesce(ts < cutoff, F.lit(False)))


def _values(keys: tuple[str, ...], *holders: str) -> Column:
    """What these keys hold in a record, or in its payload."""
    return F.array_compact(F.array(*(F.try_element_at(F.col(h), F.lit(k)) for h in holders for k in keys)))


def _gathered(column: str) -> Column:
    """The sorted distinct values of an array column over a group."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(column))))


def identities(rows: DataFrame) -> DataFrame:
    """rows with what the first ids of their artifact decide.

    The first id of a codex session_meta is the artifact's own; a session_meta
    of another thread after it is retained history and adds nothing but
    supplemental ids.  Claude's ids are told apart by the first and by the first
    line that disagrees with it.
    """
    early, codex = F.col("before_cutoff"), F.col("harness") == "codex"
    meta = codex & F.col("type").eqNullSafe("session_meta")
    own = F.when(meta, F.try_element_at("inner", F.lit("id"))).when(~codex, F.try_element_at("own", F.lit("sessionId")))
    rows = rows.withColumn("meta", meta).withColumn("own_id", own).withColumn("container", F.when(meta, F.try_element_at("inner", F.lit("session_id"))))
    at = F.when(early & F.col("own_id").isNotNull(), F.col("line_no"))
    first = rows.groupBy("artifact_id").agg(F.min_by("own_id", at).alias("first_id"), F.min(at).alias("first_line"))
    rows = rows.join(first, "artifact_id", "left")
    other = F.when(early & (F.col("own_id") != F.col("first_id")), F.col("line_no"))
    mine = F.when(early & F.col("meta") & (F.col("own_id") == F.col("first_id")) & F.col("container").isNotNull(), F.col("line_no"))
    second = rows.groupBy("artifact_id").agg(F.min(other).alias("other_line"), F.min_by("container", mine).alias("first_container"))
    return rows.join(second, "artifact_id", "left")


def artifact_census(rows: DataFrame, artifacts: DataFrame | None = None) -> DataFrame:
    """One row an artifact: counters, window totals, identity, status, reason.

    artifacts (artifact_id, harness, fault) lists all that were discovered, so
    that empty, refused, changed and unreadable files are accounted for too.
    """
    rows = identities(rows)
    early, inside, parsed, codex = F.col("before_cutoff"), F.col("inside"), F.col("state") == "parsed", F.col("harness") == "codex"
    none = F.array().cast("array<string>")
    is_first = F.coalesce(F.col("own_id") == F.col("first_id"), F.lit(False))
    # a codex session_meta of another thread than the first, or of none, after the first
    history = F.col("meta") & ~is_first & F.coalesce(F.col("line_no") > F.col("first_line"), F.lit(False))
    counts = early & ~history
    alone = F.array_compact(F.array(F.col("own_id"), F.col("container")))
    fallback = F.when(codex, F.when(F.col("meta"), none).otherwise(_values(L.FALLBACK_KEYS, "inner"))).otherwise(_values(L.FALLBACK_KEYS, "own", "inner"))
    more = (
        F.when(codex & history, F.filter(alone, lambda x: ~x.eqNullSafe(F.col("first_id")) | x.eqNullSafe(F.col("container"))))
        .when(codex & F.col("meta") & is_first, F.filter(F.array_compact(F.array("container")), lambda x: x != F.col("first_container")))
        .when(~codex & F.col("own_id").isNotNull(), F.filter(_values(L.FALLBACK_KEYS, "own", "inner"), lambda x: x != F.col("own_id")))
        .otherwise(none)
    )
    lists = {
        "fallback_ids": F.when(early, fallback),
        "supplemental": F.when(early, more),
        "parent_ref": F.when(counts, _values(L.PARENT_KEYS, "own", "inner")),
        "entry": F.when(counts, F.concat(_values(L.ENTRY_KEYS, "own", "inner"), F.when(codex, _values(L.PAYLOAD_ENTRY_KEYS, "inner")).otherwise(none))),
        "kind": F.when(counts, _values(L.KIND_KEYS, "own", "inner")),
        "cwd": F.when(counts, _values(L.DIRECTORY_KEYS, "own", "inner")),
        "side": F.when(counts, F.col("side")),
    }
    rows = rows.withColumns(lists)
    # an id that comes late and contradicts what was known by then
    late = parsed & (F.col("stamp") == "valid") & ~early & F.col("own_id").isNotNull() & (F.col("own_id") != F.col("first_id")) & (F.col("first_line") < F.col("line_no"))
    late = late & (codex | F.coalesce(F.col("line_no") < F.col("other_line"), F.lit(True)))
    by = rows.groupBy("harness", "artifact_id").agg(
        F.count(F.lit(1)).alias("total_lines"),
        *(F.count_if(F.col("state") == s).alias(f"{s}_lines") for s in ("blank", "oversized", "malformed", "parsed")),
        F.count_if(parsed & (F.col("stamp") == "missing")).alias("missing_timestamps"),
        F.count_if(parsed & (F.col("stamp") == "invalid")).alias("invalid_timestamps"),
        F.count_if(parsed & ~census.known_type(F.col("harness"), F.col("type"))).alias("unknown_types"),
        F.count_if(F.coalesce(late, F.lit(False))).alias("post_cutoff_conflicts"),
        F.count_if(inside).alias("events"),
        F.coalesce(F.sum(F.when(inside, F.octet_length("canonical") + 1)), F.lit(0)).alias("canonical_bytes"),
        F.min(F.when(inside, F.col("ts"))).alias("first_ts"), F.max(F.when(inside, F.col("ts"))).alias("last_ts"),
        F.min("first_id").alias("first_id"), F.min("first_container").alias("first_container"), F.min("other_line").alias("other_line"),
        *(_gathered(c).alias(c) for c in lists),
    )
    by = by.join(census.content_hash(rows.filter("inside"), ["artifact_id"], ["line_no"], F.col("canonical")), "artifact_id", "left")
    fault = F.lit(None).cast("string")
    if artifacts is not None:
        by = artifacts.select("artifact_id", F.col("harness").alias("a_harness"), "fault").join(by, "artifact_id", "left")
        numbers = [f.name for f in by.schema if f.dataType.typeName() == "long" and f.name != "other_line"]
        by = by.withColumn("harness", F.coalesce("harness", "a_harness")).drop("a_harness").withColumns({n: F.coalesce(n, F.lit(0)) for n in numbers})
        by = by.withColumns({c: F.coalesce(c, F.array().cast(by.schema[c].dataType)) for c in lists})
        fault = F.col("fault")
    one = lambda c: F.when(F.size(c) == 1, F.element_at(c, 1)).otherwise(ids.UNKNOWN)
    several = F.col("other_line").isNotNull()
    by_fallback = one("fallback_ids")
    session = F.when(codex, F.coalesce("first_id", by_fallback)).when(several, ids.UNKNOWN).otherwise(F.coalesce("first_id", by_fallback))
    unsure = F.col("first_id").isNull() & (F.size("fallback_ids") > 1)
    conflict = F.when(codex, unsure).otherwise(several | unsure)
    failed = fault.isin("source_read_failed", "source_unstatable", "source_path_unresolvable", "source_open_failed", "descriptor_check_failed")
    usual, reason = census.terminal_status(F.lit(False), F.lit(False), F.col("oversized_lines"), F.col("malformed_lines"), F.col("events"))
    status = F.when(failed, "failed").when(fault.isNotNull(), "quarantined").otherwise(usual)
    out = by.withColumn("session_id", session).withColumn("conflicting_ids", conflict)
    out = out.withColumn("container_id", F.when(codex, F.coalesce("first_container", "session_id")).otherwise(F.col("session_id")))
    out = out.withColumn("missing_session_id", F.col("session_id") == ids.UNKNOWN).withColumn("supplemental_ids", F.size("supplemental"))
    out = out.withColumn("parent_ref", one("parent_ref")).withColumn("entry", one("entry")).withColumn("kind", one("kind"))
    category, _ = census.working_directory(F.array_join("cwd", "\n"), "/project/")
    category = F.when(F.size("cwd") == 0, "unknown").otherwise(category)
    out = out.withColumn("directory", category).withColumn("sidechain", F.when(F.size("side") == 1, F.element_at("side", 1)))
    shape, provenance = census.execution_shape(F.col("entry"), F.col("kind"), F.col("directory"))
    out = out.withColumn("shape", shape).withColumn("shape_provenance", provenance).withColumn("source_kind", census.source_kind(F.col("parent_ref"), F.col("sidechain")))
    out = out.withColumn("status", status).withColumn("reason", F.coalesce(fault, reason)).withColumn("content_sha256", F.coalesce("content_sha256", F.lit(ids.UNKNOWN)))
    out = scratch.stored(out, scratch.folder(rows.sparkSession, "artifacts"))  # children and parents are both of it
    parents = census.resolve_parents(out.select("artifact_id", "parent_ref"), out.filter(F.col("session_id") != ids.UNKNOWN).select("session_id", F.col("artifact_id").alias("p_id")), "parent_ref", "session_id", "p_id")
    anchor = F.when(F.col("container_id") != ids.UNKNOWN, F.col("container_id")).when(F.col("session_id") != ids.UNKNOWN, F.col("session_id")).otherwise(F.col("parent_ref"))
    unknown = {n: F.lit(ids.UNKNOWN) for n in ("prompt_hash", "input_hash", "code_version", "configuration_version", "source_dataset", "injected_context_fingerprint")}
    group = ids.canonical_id("dependence-", harness=F.col("harness"), group_anchor=anchor, session_container_id=F.col("container_id"), parent_reference=F.col("parent_ref"), entry_point=F.col("entry"), session_kind=F.col("kind"), working_directory_category=F.col("directory"), **unknown)
    return out.join(parents.select("artifact_id", "parent_id"), "artifact_id").withColumn("dependence_group_id", group).drop("first_id", "first_container", "other_line", "fallback_ids", "supplemental", "cwd", "side", "fault")


def normalized_events(rows: DataFrame) -> DataFrame:
    """In-window records to events: ordinal (in-window only), part, role, strength, text.

    Claude content blocks and codex message, call and output items are covered;
    blank texts give no event.
    """
    inside = rows.filter("inside").withColumn("ordinal", F.row_number().over(Window.partitionBy("artifact_id").orderBy("line_no")))
    block = "struct<type:string,text:string,id:string,input:string,content:string>"
    whole = F.get_json_object("canonical", "$.message.content")
    blocks = F.from_json(whole, f"array<{block}>")
    plain = F.array(F.struct(F.lit("text").alias("type"), F.coalesce(whole, F.get_json_object("canonical", "$.content")).alias("text"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("input"), F.lit(None).cast("string").alias("content")))
    parts = F.when(F.startswith(F.ltrim(F.coalesce(whole, F.lit(""))), F.lit("[")), blocks).otherwise(plain)
    claude = inside.filter("harness = 'claude'").filter(F.col("type").isin("user", "assistant", "system")).select("artifact_id", "ordinal", "ts", "type", F.posexplode(parts).alias("i", "b"))
    is_result, is_use = F.col("b.type") == "tool_result", F.col("b.type") == "tool_use"
    claude = claude.select(
        "artifact_id", "ordinal", "ts", (F.col("i") + 1).alias("part"), F.when(is_result, "tool_result").when(is_use, "tool").otherwise(F.col("type")).alias("role"),
        F.when(is_result, "observed").when(is_use | (F.col("type") != "user"), "reasoned").otherwise("asserted").alias("strength"),
        F.when(is_result, F.col("b.content")).when(is_use, F.col("b.input")).otherwise(F.col("b.text")).alias("text"),
    )
    kind = F.get_json_object("canonical", "$.payload.type")
    content = F.from_json(F.get_json_object("canonical", "$.payload.content"), "array<struct<type:string,text:string>>")
    said = F.array_join(F.transform(content, lambda c: c["text"]), "\n")
    speaker = F.get_json_object("canonical", "$.payload.role")
    codex = inside.filter("harness = 'codex' AND type = 'response_item'").select(
        "artifact_id", "ordinal", "ts", F.lit(1).alias("part"),
        F.when(kind == "message", speaker).when(kind == "function_call", "tool").when(kind == "function_call_output", "tool_result").alias("role"),
        F.when(kind == "message", F.when(speaker == "user", "asserted").otherwise("reasoned")).when(kind == "function_call", "reasoned").when(kind == "function_call_output", "observed").alias("strength"),
        F.when(kind == "message", said).when(kind == "function_call", F.get_json_object("canonical", "$.payload.arguments")).when(kind == "function_call_output", F.get_json_object("canonical", "$.payload.output")).alias("text"),
    )
    events = claude.unionByName(codex).filter(F.col("role").isNotNull() & (F.trim("text") != ""))
    event_id = ids.stable_id("event-", F.col("artifact_id"), F.lit("1"), F.col("ordinal"), F.col("part"), F.col("role"))
    return events.withColumn("event_id", event_id).withColumn("too_large", F.octet_length("text") > L.MAX_EVENT_BYTES)
