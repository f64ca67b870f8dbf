"""Normalised events to redacted packets, and what becomes of each artifact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions import ids, text
from siftline.functions import lexicons as L
from siftline.operators import packing

#: Reasons in the order in which an event is checked.
CHECKS = ("unknown_injected_context", "instruction_role_content", "credential_detected", "event_too_large")
PROVIDER_FIELDS = ("event_id", "ordinal", "role", "strength", "evidence_uri", "text")


def checked_events(events: DataFrame) -> DataFrame:
    """events (artifact_id, harness, ordinal, part, role, text, event_id) with reason and redacted text.

    The first check that fails gives the reason; texts with a credential or a
    secret are never redacted, they quarantine.
    """
    unknown = F.lit(False)
    for pattern in L.UNKNOWN_INSTRUCTIONS:
        unknown = unknown | F.regexp_like("text", F.lit(pattern))
    credential = (F.size(text.credential_ids(F.col("text"))) > 0) | text.high_entropy_secret()("text")
    out = events.withColumn("__r", text.redacted(F.col("text")))
    out = out.withColumn("redacted", text.escape_markup(F.col("__r.text"))).withColumn("redactions", F.col("__r.count")).drop("__r")
    tests = (unknown, F.col("role").isin("system", "developer", "hook") & (F.trim("text") != ""), credential, F.octet_length("redacted") > L.MAX_EVENT_BYTES)
    reason = F.coalesce(*(F.when(test, name) for name, test in zip(CHECKS, tests, strict=True)))
    return out.withColumn("reason", reason)


def artifact_outcomes(checked: DataFrame) -> DataFrame:
    """artifact_id, status, reason, events: the earliest failed check quarantines the whole artifact."""
    at = F.when(F.col("reason").isNotNull(), F.struct("ordinal", "part"))
    by = checked.groupBy("artifact_id").agg(F.min_by("reason", at).alias("reason"), F.count(F.lit(1)).alias("events"))
    return by.withColumn("status", F.when(F.col("reason").isNull(), "prepared_no_egress").otherwise("quarantined"))


def build_packets(checked: DataFrame, version: str = "1", max_bytes: int = min(L.MAX_PACKET_BYTES, L.MAX_PACKET_TOKENS * L.BYTES_PER_TOKEN), frame: int = 512) -> DataFrame:
    """packet_id, artifact_id, event_ids, events, bytes, tokens of all artifacts that are safe.

    A packet is a run of events in order whose provider form, with frame bytes
    around it, fits; artifacts with an event that does not are left out.
    """
    safe = artifact_outcomes(checked).filter("status = 'prepared_no_egress'").select("artifact_id")
    own = checked.join(safe, "artifact_id", "left_semi")
    uri = ids.evidence_uri(F.col("harness"), F.col("artifact_id"), F.lit(version), F.col("event_id"))
    own = own.withColumn("event", F.to_json(F.struct(F.col("event_id"), uri.alias("evidence_uri"), F.col("ordinal"), F.col("role"), F.col("strength"), F.col("redacted").alias("text"))))
    packed = packing.greedy(own, ["artifact_id"], ["ordinal", "part"], F.octet_length("event") + 32, max_bytes - frame, ["event_id", "event"])
    by = packed.groupBy("artifact_id", "packet").agg(F.array_sort(F.collect_list(F.struct("ordinal", "part", "event_id", "event"))).alias("rows"), F.sum("size").alias("size"), F.bool_or("overflow").alias("overflow"))
    event_ids = F.transform("rows", lambda r: r["event_id"])
    by = by.withColumn("event_ids", event_ids).withColumn("events", F.transform("rows", lambda r: r["event"]))
    key = F.concat(F.lit('{"artifact_id":"'), F.col("artifact_id"), F.lit('","event_ids":["'), F.array_join("event_ids", '","'), F.lit('"],"source_version":"'), F.lit(version), F.lit('"}'))
    total = (F.col("size") + frame).alias("bytes")
    over = F.max("overflow").over(Window.partitionBy("artifact_id"))
    by = by.withColumn("any_over", over).filter(~F.col("any_over"))
    return by.select(F.concat(F.lit("packet-"), F.substring(F.sha2(key, 256), 1, 24)).alias("packet_id"), "artifact_id", "packet", "event_ids", "events", total, F.floor((F.col("size") + frame + 2) / 3).cast("long").alias("tokens"))


def unsafe_packets(packets: DataFrame) -> DataFrame:
    """Packets in which a scan after serialisation still finds a credential or markup."""
    body = F.array_join("events", "\n")
    return packets.filter((F.size(text.credential_ids(body)) > 0) | text.has_markup(body))


def event_coverage(checked: DataFrame, packets: DataFrame) -> DataFrame:
    """event_id, packet_id, disposition: every event is in one packet, or quarantined with its artifact."""
    held = packets.select("packet_id", F.explode("event_ids").alias("event_id"))
    joined = checked.select("artifact_id", "event_id").join(held, "event_id", "left")
    return joined.withColumn("disposition", F.when(F.col("packet_id").isNull(), "quarantined").otherwise("packet"))


def compact(packets: DataFrame, limit: int = L.COMPACT_BYTES) -> DataFrame:
    """packet_id, event_ids, texts: the events by id that fit, the first cut to fit if none does."""
    rows = packets.select("packet_id", F.explode("events").alias("e")).select("packet_id", F.get_json_object("e", "$.event_id").alias("event_id"), F.get_json_object("e", "$.text").alias("text"))
    w = Window.partitionBy("packet_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    sized = rows.withColumn("running", F.sum(F.octet_length("text") + 256).over(w)).withColumn("k", F.row_number().over(Window.partitionBy("packet_id").orderBy("event_id")))
    # the longest prefix in characters whose bytes fit: at least limit/4 characters, at most limit
    room = limit - 256
    cut = F.aggregate(F.sequence(F.lit(1), F.lit(13)), F.struct(F.lit(0).alias("low"), F.lit(room).alias("high")), lambda acc, _: F.struct(
        F.when(F.octet_length(F.substr(F.col("text"), F.lit(1), F.ceil((acc["low"] + acc["high"]) / 2).cast("int"))) <= room, F.ceil((acc["low"] + acc["high"]) / 2).cast("int")).otherwise(acc["low"]).alias("low"),
        F.when(F.octet_length(F.substr(F.col("text"), F.lit(1), F.ceil((acc["low"] + acc["high"]) / 2).cast("int"))) <= room, acc["high"]).otherwise(F.ceil((acc["low"] + acc["high"]) / 2).cast("int") - 1).alias("high"),
    ), lambda acc: acc["low"])
    fits = F.when(F.col("running") <= limit, F.col("text")).when(F.col("k") == 1, F.substr(F.col("text"), F.lit(1), cut))
    kept = sized.withColumn("text", fits).filter(F.col("text").isNotNull())
    return kept.groupBy("packet_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "text"))).alias("rows")).select("packet_id", F.transform("rows", lambda r: r["event_id"]).alias("event_ids"), F.transform("rows", lambda r: r["text"]).alias("texts"))


def provider_view(events: Column) -> Column:
    """Only the approved fields of an array of event structs."""
    return F.transform(events, lambda e: F.struct(*(e[f].alias(f) for f in PROVIDER_FIELDS)))
