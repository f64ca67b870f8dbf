"""The seam to an outside model: release gate, batches, results, failures.

The runner is any callable over a batch's payloads; nothing here calls a
service.  Batches that have results are skipped, so a rerun does only the rest, and
answers can be kept as they come, so that a task that runs again does not call again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.operators import review

Runner = Callable[[Sequence[str]], Sequence[str]]
# --- fixed values: what each harness may be released to ---
AFFINITY = {"codex": ("openai", "authenticated-first-party-codex"), "claude": ("anthropic", "authenticated-first-party-claude")}


def release_errors() -> Column:
    """Sorted error codes of a row with the release's fields (r_*) and the work item's own."""
    is_true = lambda c: F.coalesce(F.col(c), F.lit(False))
    wanted = lambda k: F.coalesce(*(F.when(F.col("harness") == h, F.lit(v[k])) for h, v in AFFINITY.items()))
    known = F.coalesce(F.col("harness").isin(*AFFINITY), F.lit(False))
    differs = lambda a, b: ~F.col(a).eqNullSafe(b)
    checks = [
        (differs("r_provider", wanted(0)), "provider_affinity_mismatch"), (differs("r_account", wanted(1)), "account_affinity_mismatch"), (~is_true("r_account_verified"), "account_unverified"),
        (F.coalesce(F.trim("r_model"), F.lit("")).eqNullSafe("") | ~is_true("r_model_verified"), "model_unverified"), (differs("r_prompt_sha256", F.col("prompt_sha256")), "prompt_mismatch"), (differs("r_policy_version", F.col("policy_version")), "policy_mismatch"),
        (differs("r_approved_fields", F.col("approved_fields")), "approved_fields_mismatch"), (F.coalesce(F.size("r_raw_tools"), F.lit(-1)) != 0, "raw_tools_not_disabled"), (F.col("r_fallback_provider").isNotNull(), "fallback_provider_forbidden"), (~is_true("r_transport_verified"), "transport_unverified"),
    ]
    return F.when(~known, F.array(F.lit("work_item_harness_invalid"))).otherwise(review.error_list(checks))


def unwrap(response: Column) -> Column:
    """The structured document in a provider's JSON answer, or null."""
    own = F.get_json_object(response, "$.structured_output")
    result = F.get_json_object(response, "$.result")
    whole = F.when(F.get_json_object(response, "$.candidates").isNotNull(), response)
    an_object = lambda c: F.when(F.startswith(F.ltrim(c), F.lit("{")) & F.try_parse_json(c).isNotNull(), c)
    return F.coalesce(an_object(own), an_object(result), whole)


def total_input_tokens(plain: Column, created: Column, read: Column) -> Column:
    """Cache-inclusive usage; null if nothing is told, negative, or a small uncached count alone."""
    told = F.coalesce(plain, created, read).isNotNull()
    negative = F.least(F.coalesce(plain, F.lit(0)), F.coalesce(created, F.lit(0)), F.coalesce(read, F.lit(0))) < 0
    alone = plain.isNotNull() & created.isNull() & read.isNull() & (plain < 100)
    return F.when(told & ~negative & ~alone, F.coalesce(plain, F.lit(0)) + F.coalesce(created, F.lit(0)) + F.coalesce(read, F.lit(0)))


def failure_code(failure: Column) -> Column:
    """What may be told of a failure: letters, digits, underscore and hyphen, 80 at most."""
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(failure, "[^A-Za-z0-9_-]", ""), 1, 80), F.lit("")), F.lit("provider_failure"))


def cost(input_tokens: Column, output_tokens: Column, input_price: str, output_price: str) -> Column:
    """Decimal cost at prices a million tokens, six places, half up."""
    total = input_tokens.cast("decimal(18,0)") * F.lit(input_price).cast("decimal(18,6)") + output_tokens.cast("decimal(18,0)") * F.lit(output_price).cast("decimal(18,6)")
    return F.round(total / F.lit(1_000_000), 6).cast("decimal(38,6)")


def attempts(failures: DataFrame, item: str, order: str, failure: str) -> DataFrame:
    """Numbered attempts up to the first exact repeat of a failure, which is terminal."""
    w = Window.partitionBy(item).orderBy(order)
    rows = failures.withColumn("attempt_number", F.row_number().over(w)).withColumn("failure_fingerprint", F.sha2(failure, 256)).withColumn("failure_code", failure_code(F.col(failure)))
    rows = rows.withColumn("repeat", F.col("failure_fingerprint").eqNullSafe(F.lag("failure_fingerprint").over(w)))
    before = F.coalesce(F.max(F.col("repeat").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("ended", before).filter("ended = 0").drop("ended")
    return rows.withColumn("status", F.when(F.col("repeat"), "failed").otherwise("retrying")).drop("repeat")


def _kept(store: str, batch: str) -> tuple[pafs.FileSystem, str]:
    fs, folder = pafs.FileSystem.from_uri(store if "://" in store else "file://" + store.removeprefix("file:"))
    fs.create_dir(folder, recursive=True)
    return fs, f"{folder}/{hashlib.sha256(batch.encode()).hexdigest()[:32]}.json"


def run_batches(items: DataFrame, runner: Runner, done: DataFrame | None = None, store: str | None = None) -> DataFrame:
    """items (batch_id, work_item_id, payload) to (batch_id, work_item_id, status, result).

    Each batch is one call with its payloads in order of work item; batches in
    done are skipped.  An answer of another length, or an error, ends the batch
    as failed with a safe code.  With store, a folder that executors share, an
    answer is kept there under its batch before anything else happens, so that a
    task that runs again does not call again.
    """
    if done is not None:
        items = items.join(done.select("batch_id").distinct(), "batch_id", "left_anti")

    def ask(payloads: list[str]) -> tuple[str, list[str]]:
        try:
            answers = list(runner(payloads))
        except Exception as e:  # the seam: whatever a provider raises ends this batch only
            return "failed", ["".join(c for c in type(e).__name__ if c.isalnum())[:80]] * len(payloads)
        return ("complete", answers) if len(answers) == len(payloads) else ("failed", ["coverage_mismatch"] * len(payloads))

    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("work_item_id")
        payloads = list(pdf["payload"])
        if store is None:
            status, answers = ask(payloads)
        else:
            fs, path = _kept(store, str(pdf["batch_id"].iloc[0]))
            if fs.get_file_info(path).type == pafs.FileType.NotFound:
                own = f"{path}.{uuid.uuid4().hex}"
                with fs.open_output_stream(own) as out:
                    out.write(json.dumps(ask(payloads)).encode())
                fs.move(own, path)
            with fs.open_input_stream(path) as kept:
                status, answers = json.loads(kept.read())
        return pdf[["batch_id", "work_item_id"]].assign(status=status, result=answers)

    return items.select("batch_id", "work_item_id", "payload").groupBy("batch_id").applyInPandas(call, "batch_id string, work_item_id string, status string, result string")


def calibration_examples(rows: DataFrame) -> DataFrame:
    """Bounded examples for a prompt: title, content and action cut to 180, 700 and 500 characters."""
    return rows.select(F.substring("title", 1, 180).alias("title"), F.substring("content", 1, 700).alias("content"), F.substring("action", 1, 500).alias("recommended_action"), "topic", "learning_type").orderBy("topic", "title")
