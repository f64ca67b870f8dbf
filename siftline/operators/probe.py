"""Value probe: scores, top events, novelty against a baseline, blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.functions import blocks, text


#: Characters of an event's text that a probe packet shows.
SHOWN = 2400


def top_events(scored: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of each group by score, then id; only positive scores count."""
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
    return scored.filter("score > 0").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def select_roots(artifacts: DataFrame, k: int = 8, least: int = 8) -> DataFrame:
    """The k root artifacts without a parent that have the most marketing events, then events; fewer than least are an error."""
    roots = artifacts.filter("source_kind = 'root' AND parent_artifact_id IS NULL").orderBy(F.desc("marketing_events"), F.desc("events"), "artifact_id").limit(k)
    if (found := roots.count()) < least:
        raise ValueError(f"{found} root artifacts, {least} are needed")
    return roots


def refuse_sidechains(records: DataFrame, sidechain: str = "sidechain") -> DataFrame:
    """records, or an error naming an artifact that holds a sidechain record."""
    bad = records.filter(F.col(sidechain).eqNullSafe(True)).agg(F.min("artifact_id")).first()[0]
    if bad is not None:
        raise ValueError(f"non_root_source:{bad}")
    return records


def record_strength(record: Column) -> Column:
    """Evidence strength by the shape of a JSON record: a user record is observed only as a verified tool result.

    That is one with a toolUseResult whose message is the user's and holds tool
    results alone, each with the id of its use.
    """
    value = F.try_parse_json(record)
    kind = F.try_variant_get(value, "$.type", "string")
    parts = F.try_variant_get(value, "$.message.content", "array<variant>")

    def is_result(part: Column) -> Column:
        use = F.try_variant_get(part, "$.tool_use_id", "variant")
        named = (F.schema_of_variant(use) == "STRING") & (F.trim(F.try_variant_get(part, "$.tool_use_id", "string")) != "")
        return F.coalesce((F.try_variant_get(part, "$.type", "string") == "tool_result") & named, F.lit(False))

    told = F.try_variant_get(value, "$.toolUseResult", "variant").isNotNull() & (F.try_variant_get(value, "$.message.role", "string") == "user")
    verified = F.coalesce(told & (F.size(parts) > 0) & F.forall(parts, is_result), F.lit(False))
    return F.when(kind == "user", F.when(verified, "observed").otherwise("asserted")).when(kind == "assistant", "reasoned")


def call_batches(items: DataFrame, keys: list[str], order: list[str], n: int = 4) -> DataFrame:
    """items with batch: n in order to a call, from 0, for each group."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return items.withColumn("batch", F.floor((nth - 1) / n).cast("int"))


def novelty(candidates: DataFrame, baseline: DataFrame, key: str, least_shared: int = 4, threshold: float = 0.60) -> DataFrame:
    """key, outcome: the first baseline item (by id) that a candidate restates, or novel.

    candidates (key, tokens), baseline (id, tokens).  An item matches when its
    token set is equal, or shares at least least_shared tokens at a Jaccard
    similarity of at least threshold.  Pairs meet on shared tokens, so nothing
    is compared that has nothing in common; counts are summed by pair.
    """
    items = baseline.select(F.col("id").alias("b_id"), F.size("tokens").alias("b_n"), F.explode("tokens").alias("token"))
    words = candidates.select(key, F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    meets = words.join(items, "token").groupBy(key, "b_id").agg(F.count(F.lit(1)).alias("common"), F.first("n").alias("n"), F.first("b_n").alias("b_n"))
    union = F.col("n") + F.col("b_n") - F.col("common")
    exact = (F.col("common") == F.col("n")) & (F.col("common") == F.col("b_n"))
    hit = meets.filter(exact | ((F.col("common") >= least_shared) & (F.col("common") / union >= threshold)))
    label = F.when(exact, "exact_baseline_match:").otherwise("semantic_baseline_match:")
    own_id = F.col("b_id").cast("string")  # ids rank as text
    first = hit.groupBy(key).agg(F.min_by(F.concat(label, own_id), own_id).alias("match"))
    return candidates.select(key).join(first, key, "left").select(key, F.coalesce("match", F.lit("novel")).alias("outcome"))


def block_digests(rows: DataFrame, column: str, start: str, end: str, k: int) -> list[str]:
    """Fingerprints of the k most frequent blocks: candidates for a policy, which is short by nature."""
    pattern = f"(?s){re.escape(start)}.*?{re.escape(end)}"
    blocks = rows.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0))).alias("b"))
    often = blocks.select(text.fingerprint(F.col("b")).alias("d")).groupBy("d").count().orderBy(F.desc("count"), "d").limit(k)
    return sorted(r.d for r in often.collect())


def strip_blocks(rows: DataFrame, column: str, rules: Sequence[tuple[str, str, str, Sequence[str]]]) -> DataFrame:
    """rows with status, reason, remaining and excluded.

    rules are (id, start, end, registered digests).  A registered block is cut
    out; a changed or open one, or an unknown instruction in what remains,
    quarantines the row.  Literal search needs a cursor, hence Arrow batches.
    """
    look = blocks.Inspector([blocks.Rule(start, end, frozenset(digests)) for _, start, end, digests in rules])

    def inspect(value: str | None) -> tuple[str, str | None, str | None, int]:
        found = look(value)
        return "quarantined" if found.reason else "safe", found.reason, found.remaining, len(found.fingerprints)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [inspect(v) for v in pdf[column]]
            yield pdf.assign(**{name: [g[i] for g in got] for i, name in enumerate(("status", "reason", "remaining", "excluded"))})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", status string, reason string, remaining string, excluded int"
    return rows.mapInPandas(run, schema)
