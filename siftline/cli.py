"""Command line: census, normalize, groups, pilot, publish.

Exit status 0 is done, 2 is failed or of reduced scope.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from siftline.functions import lexicons as L
from siftline.operators import assignment, estimate, packets, review, sessions
from siftline.operators import normalize as normal
from siftline.sources import jsonl, scratch, sinks


def session() -> SparkSession:
    return SparkSession.builder.appName("siftline").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _rows(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, jsonl.Discovery, dict[str, str]]:
    roots = {h: r for h, r in (("codex", args.codex), ("claude", args.claude)) if r}
    found = jsonl.discover(roots)
    if found.refused or found.unreadable:
        print(json.dumps({"refused": [[h, reason] for h, _, reason in found.refused], "unreadable_folders": found.unreadable}), file=sys.stderr)
    kept: dict[str, list[str]] = {}
    for harness, path in found.files:
        kept.setdefault(harness, []).append(path)
    lines = jsonl.read_lines(spark, kept)
    at = lambda v: F.lit(v).cast("timestamp")
    rows = scratch.stored(sessions.records(lines, roots, at(args.start), at(args.cutoff)), f"{scratch.folder(spark, 'rows')}")
    return rows, found, roots


def _manifest(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    """(rows, census): every file found is accounted for, with what changed while it was read."""
    rows, found, roots = _rows(spark, args)
    listed = found.artifacts(spark, found.changes())
    artifacts = listed.select(sessions.artifact_key(F.col("harness"), F.col("path"), roots).alias("artifact_id"), "harness", "fault")
    return rows, scratch.stored(sessions.artifact_census(rows, artifacts), scratch.folder(spark, "census"))


def census(spark: SparkSession, args: argparse.Namespace) -> int:
    _, manifest = _manifest(spark, args)
    summary = manifest.groupBy("harness", "status").agg(F.count(F.lit(1)).alias("artifacts"), F.sum("events").alias("events"), F.sum("canonical_bytes").alias("bytes"))
    coverage = manifest.select("artifact_id", "harness", "status", "reason", (F.col("events") > 0).alias("in_window"))
    sinks.write_run({"manifest": manifest, "coverage": coverage, "summary": summary}, args.out)
    if args.twice:  # determinism: another scan gives the same hashes
        digest = lambda df: df.agg(F.bit_xor(F.xxhash64("artifact_id", "content_sha256", "status"))).first()[0]
        if digest(_manifest(spark, args)[1]) != digest(spark.read.parquet(f"{args.out}/manifest")):
            print("the scans differ", file=sys.stderr)
            return 2
    return 0


def normalize(spark: SparkSession, args: argparse.Namespace) -> int:
    rows, manifest = _manifest(spark, args)
    done = normal.normalize(rows, manifest)
    sinks.write_run({"packets": done.packets, "outcomes": done.outcomes, "coverage": done.coverage, "summary": normal.summary(done), "reasons": normal.reasons(done)}, args.out)
    broken = normal.covered(done).filter("NOT whole").limit(1).count()
    return 2 if broken or packets.unsafe_packets(spark.read.parquet(f"{args.out}/packets")).limit(1).count() else 0


def groups(spark: SparkSession, args: argparse.Namespace) -> int:
    manifest, built = spark.read.parquet(f"{args.census}/manifest"), spark.read.parquet(f"{args.packets}/packets")
    joined = manifest.join(built.select("artifact_id", "packet_id", "bytes"), "artifact_id")
    out = joined.groupBy("dependence_group_id").agg(F.array_sort(F.collect_set("artifact_id")).alias("members"), F.array_sort(F.collect_set("packet_id")).alias("packets"), F.min("packet_id").alias("representative"))
    costs = estimate.tiered(F.count(F.lit(1)))
    total = out.agg(*(c.alias(n) for n, c in costs.items()))
    try:
        estimate.enforce(total, L.FULL_LIMITS)
    except estimate.BudgetExceeded as e:
        print(str(e), file=sys.stderr)
        return 2
    sinks.write_run({"groups": out, "estimate": total}, args.out)
    return 0


def pilot(spark: SparkSession, args: argparse.Namespace) -> int:
    rows = spark.read.parquet(args.rows)
    if rows.limit(24).count() < 24:
        print("fewer than 24 packets", file=sys.stderr)
        return 2
    sinks.write_run({"selection": assignment.select_pilot(assignment.slots(spark), rows)}, args.out)
    return 0


def publish(spark: SparkSession, args: argparse.Namespace) -> int:
    candidates, decisions = spark.read.parquet(args.candidates), spark.read.parquet(args.decisions)
    if review.coverage_gaps(candidates, decisions, "candidate_id").limit(1).count():
        print("not every candidate has one decision", file=sys.stderr)
        return 2
    learnings = review.publish(candidates, decisions)
    sinks.write_run({"learnings": learnings}, args.out)
    if args.page:  # reviewed rows: as many as people have decided on
        sinks.private_document(args.page, sinks.page([r.asDict() for r in learnings.orderBy("learning_id").collect()], "Findings", ("title", "content", "action", "topic", "claim_label")))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="siftline")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for name, run in (("census", census), ("normalize", normalize)):
        p = verbs.add_parser(name)
        for o in ("--codex", "--claude"):
            p.add_argument(o)
        for o in ("--start", "--cutoff", "--out"):
            p.add_argument(o, required=True)
        p.add_argument("--twice", action="store_true")
        p.set_defaults(run=run)
    for name, run, options in (("groups", groups, ("--census", "--packets", "--out")), ("pilot", pilot, ("--rows", "--out")), ("publish", publish, ("--candidates", "--decisions", "--out"))):
        p = verbs.add_parser(name)
        for o in options:
            p.add_argument(o, required=True)
        if name == "publish":
            p.add_argument("--page")
        p.set_defaults(run=run)
    args = parser.parse_args(argv)
    return args.run(spark or session(), args)



if __name__ == "__main__":
    sys.exit(main())
