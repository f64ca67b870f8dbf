"""Validation of candidate documents against the packet they speak of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.functions import lexicons as L
from siftline.functions import text
from siftline.operators import review

CANDIDATE = "struct<candidate_id:string,topic:string,learning_type:string,claim_label:string,summary:string,title:string,recommended_action:string,transferability_rationale:string,evidence_uris:array<string>>"


def stable_candidate_id(packet: Column, c: Column) -> Column:
    """From the packet and all of the candidate but its id."""
    body = F.to_json(F.struct(*(c[f].alias(f) for f in ("claim_label", "evidence_uris", "learning_type", "recommended_action", "summary", "title", "topic", "transferability_rationale"))))
    return F.concat(F.lit("candidate-"), F.substring(F.sha2(F.concat(packet, F.lit("\0"), body), 256), 1, 24))


def validate(documents: DataFrame, packets: DataFrame) -> DataFrame:
    """documents (packet_id, result_type, no_learning_reason, candidates) to packet_id, errors, terminal_status.

    packets is (packet_id, strengths map<uri, strength>).  A data claim needs
    every cited event observed; nothing may cite beyond its packet.
    """
    rows = documents.join(packets.select(F.col("packet_id").alias("p_id"), "strengths"), F.col("packet_id") == F.col("p_id"), "left")
    cands = F.coalesce(F.col("candidates"), F.array().cast(f"array<{CANDIDATE}>"))
    strengths = F.coalesce(F.col("strengths"), F.create_map().cast("map<string,string>"))
    nothing = F.col("result_type") == "no_learning"
    code = lambda i, what: F.concat(F.lit("candidate["), i.cast("string"), F.lit(f"]{what}"))
    ids_ = F.transform(cands, lambda c: c["candidate_id"])

    def own(c: Column, i: Column) -> Column:
        words = text.tokens(F.concat_ws(" ", c["summary"], c["transferability_rationale"]))
        lesson = (c["topic"] == "ai_and_marketing_operations") & review.harness_only(words)
        earlier = F.slice(ids_, 1, i)
        checks = [
            (~c["candidate_id"].eqNullSafe(stable_candidate_id(F.col("packet_id"), c)), ".candidate_id:not_stable"), (F.array_contains(earlier, c["candidate_id"]), ".candidate_id:duplicate"), (~F.coalesce(c["topic"].isin(*L.TOPICS), F.lit(False)), ".topic:unsupported"),
            (~F.coalesce(c["learning_type"].isin(*L.LEARNING_TYPES), F.lit(False)), ".learning_type:unsupported"), (~F.coalesce(c["claim_label"].isin(*L.CLAIM_LABELS), F.lit(False)), ".claim_label:unsupported"), (F.coalesce(lesson, F.lit(False)), ":harness_only_ai_lesson"),
        ]
        return F.array(*(F.when(test, code(i, what)) for test, what in checks))

    def evidence(c: Column) -> Column:
        def one(uri: Column, j: Column) -> Column:
            place = lambda what: F.concat(F.lit("candidate.evidence_uris["), j.cast("string"), F.lit(f"]:{what}"))
            strength = F.try_element_at(strengths, uri)
            return F.when(strength.isNull(), place("not_in_packet")).when((c["claim_label"] == "[DATA]") & (strength != "observed"), place("not_observed"))

        return F.transform(F.coalesce(c["evidence_uris"], F.array().cast("array<string>")), one)

    general = F.array(
        F.when(F.col("p_id").isNull(), "document.packet_id:packet_mismatch"),
        F.when(nothing & (F.size(cands) > 0), "no_learning.candidates:must_be_empty"),
        F.when(nothing & (F.coalesce(F.trim("no_learning_reason"), F.lit("")) == ""), "no_learning_reason:required"),
        F.when((F.col("result_type") == "candidates") & (F.size(cands) == 0), "candidates:minItems"),
        F.when(~F.coalesce(F.col("result_type").isin("candidates", "no_learning"), F.lit(False)), "result_type:invalid"),
    )
    deep = F.concat(F.flatten(F.transform(cands, own)), F.flatten(F.transform(cands, evidence)))
    errors = F.array_sort(F.array_distinct(F.array_compact(F.when(nothing, general).otherwise(F.concat(general, deep)))))
    out = rows.select("packet_id", "result_type", errors.alias("errors"))
    return out.withColumn("terminal_status", F.when(F.size("errors") > 0, "rejected_invalid").when(F.col("result_type") == "no_learning", "no_learning").otherwise("extracted"))
