"""Golden values and brute force for text functions, packing, estimates and assignment."""

import itertools
import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftline.functions import ids, text
from siftline.functions import lexicons as L
from siftline.operators import assignment, census, estimate, groups, packing, probe, review


def value(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_entropy(spark):
    for s in ("", "aabb", "abcd", "xéxé1"):
        want = -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0
        assert value(spark, text.entropy(F.lit(s))) == pytest.approx(want)


def test_redaction_order_and_count(spark):
    said = "mail a.b@c.org or +1 (555) 010-9999, see /tmp/secret/x, name: Ann Lee, internal id: ab-12"
    out, count = text.redact(F.lit(said))
    row = spark.range(1).select(out.alias("t"), count.alias("n")).first()
    assert row.t == "mail [REDACTED:email] or [REDACTED:phone], see [REDACTED:local-path] [REDACTED:personal-name], [REDACTED:proprietary-id]"
    assert row.n == 5


def test_date_counts_as_phone(spark):
    out, _ = text.redact(F.lit("on 2026-08-20 and at 2026-08-20T10:00:00Z"))
    assert value(spark, out) == "on [REDACTED:phone] and at 2026-08-20T10:00:00Z"


def test_escape_is_idempotent(spark):
    once = text.escape_markup(F.lit("a & b &amp; <i> &#12; &#x1F; &bogus;"))
    assert value(spark, once) == "a &amp; b &amp; &lt;i&gt; &#12; &#x1F; &amp;bogus;"
    assert value(spark, text.escape_markup(once)) == value(spark, once)


def test_credentials_and_markup(spark):
    assert value(spark, text.credential_ids(F.lit("x AKIA" + "A1" * 8 + " and Bearer " + "z" * 24))) == ["aws_access_key", "bearer_token"]
    assert value(spark, text.credential_ids(F.lit("nothing here"))) == []
    assert value(spark, text.has_markup(F.lit("<p onclick = 1>")))
    assert not value(spark, text.has_markup(F.lit("<p>plain</p>")))


def test_high_entropy_secret(spark):
    secret = "abcdefghijklmnopqrstuvwxyz0123456789"
    cases = {f"token = {secret}": True, f'token = "{secret}"': False, f"word {secret}": False, "token " + "ab" * 20: False, "secret sha256:" + "0f" * 32: False}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.s for r in df.select("t", text.high_entropy_secret()("t").alias("s")).collect()}
    assert got == cases


def test_tokens_and_semantics(spark):
    assert sorted(value(spark, text.tokens(F.lit("Straße a_1 A_1 x-y")))) == ["a_1", "strasse", "x", "y"]
    assert sorted(value(spark, text.semantic_tokens(F.lit("The campaigns are Targeting an ad, checks")))) == ["campaign", "target", "verify"]
    assert value(spark, text.marketing_score(text.semantic_tokens(F.lit("increase campaign budget")))) == 5 * 2 + 2 * 1 + 2


def test_ids(spark):
    import hashlib

    want = "artifact-" + hashlib.sha256(b"h\0p/q").hexdigest()[:24]
    assert value(spark, ids.stable_id("artifact-", F.lit("h"), F.lit("p/q"))) == want
    assert value(spark, ids.canonical(b=F.lit("x"), a=F.lit(None))) == '{"a":"?","b":"x"}'
    uri = ids.evidence_uri(F.lit("h"), F.lit("a-1"), F.lit("v1"), F.lit("e.2"))
    assert [value(spark, c) for c in ids.parse_uri(uri).values()] == ["h", "a-1", "v1", "e.2"]


def test_timestamps(spark):
    cases = {"2026-08-18T13:00:00Z": "2026-08-18 13:00:00", "2026-08-18T13:00:00+02:00": "2026-08-18 11:00:00", "2026-08-18T13:00:00": None, "0": "1970-01-01 00:00:00", "1700000000000": "2023-11-14 22:13:20", "never": None}
    for s, want in cases.items():
        assert value(spark, census.parse_timestamp(F.lit(s)).cast("string")) == want, s


def test_tiered_estimate_golden(spark):
    costs = estimate.tiered(F.lit(290))
    row = spark.range(1).select(*(c.alias(n) for n, c in costs.items())).first()
    assert (row.full_groups, row.mixed_groups, row.stage_groups) == (29, 15, 44)
    assert (row.small_per_call, row.large_per_call, row.small_calls, row.large_calls, row.wall_minutes) == (93, 9, 4, 5, 100)
    estimate.enforce(spark.range(1).select(*(c.alias(n) for n, c in costs.items())), L.FULL_LIMITS)
    with pytest.raises(estimate.BudgetExceeded) as e:
        estimate.enforce(spark.createDataFrame([(500_001, 25, 1)], "input_tokens long, calls long, wall_minutes long"), L.PROBE_LIMITS)
    assert e.value.dimension == "input_tokens"


def plain_greedy(sizes, limit):
    out, packet, used = [], 1, 0
    for s in sizes:
        if used > 0 and used + s > limit:
            packet, used = packet + 1, 0
        used += s
        out.append(packet)
    return out


def test_greedy_packing(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.choice([1, 7, 30, 99, 140])) for g in range(40) for i in range(rng.randint(1, 30))]
    got = packing.greedy(spark.createDataFrame(rows, "g int, i int, s int"), ["g"], ["i"], F.col("s"), 100).collect()
    for g in range(40):
        mine = sorted((r.i, r.packet, r.overflow, r.size) for r in got if r.g == g)
        sizes = [s for h, _, s in rows if h == g]
        assert [m[1] for m in mine] == plain_greedy(sizes, 100)
        assert [m[2] for m in mine] == [s > 100 for s in sizes]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4), st.integers(4, 6), st.data())
def test_assignment_is_cheapest(slots, rows, data):
    costs = [{f"r{j}": data.draw(st.integers(0, 30)) for j in range(rows)} for _ in range(slots)]
    got = assignment.assign(costs)
    assert len(set(got)) == slots
    best = min(sum(costs[i][f"r{j}"] for i, j in enumerate(p)) for p in itertools.permutations(range(rows), slots))
    assert sum(costs[i][r] for i, r in enumerate(got)) == best


def test_slots_and_small_selection(spark):
    slots = [r.asDict() for r in assignment.slots(spark).collect()]
    assert len(slots) == 24 and slots[0]["slot_id"] == "base-01" and slots[-1]["slot_id"] == "mixed-08"
    rows = [{"packet_id": f"p{i}", "harness": "codex", "execution_kind": "sdk", "artifact_role": "root", "learning_expectation": "no_learning", "workload_class": "other"} for i in range(3)]
    chosen = assignment.select_greedy(slots, rows)
    assert [s for s, _ in chosen] == ["base-01", "base-02", "base-03"] and len({p for _, p in chosen}) == 3


def test_novelty_order(spark):
    base = spark.createDataFrame([("b2", ["aa1", "bb2", "cc3", "dd4"]), ("b1", ["aa1", "bb2", "cc3", "dd4", "ee5"])], "id string, tokens array<string>")
    mine = spark.createDataFrame([(1, ["aa1", "bb2", "cc3", "dd4"]), (2, ["aa1", "bb2"]), (3, [])], "k int, tokens array<string>")
    got = {r.k: r.outcome for r in probe.novelty(mine, base, "k").collect()}
    assert got == {1: "semantic_baseline_match:b1", 2: "novel", 3: "novel"}


def test_blocks(spark):
    known = [value(spark, text.fingerprint(F.lit("<b> fine </b>")))]
    rows = spark.createDataFrame([(1, "x <b>  fine </b> y"), (2, "x <b> changed </b>"), (3, "x <b> open"), (4, "<system>"), (5, None)], "k int, t string")
    got = {r.k: (r.status, r.reason, r.remaining) for r in probe.strip_blocks(rows, "t", [("b", "<b>", "</b>", known)]).collect()}
    assert got[1] == ("safe", None, "x  y")
    assert got[2][1] == "unknown_injected_context" and got[3][1] == "unresolved_injected_context" and got[4][1] == "unknown_injected_context"
    assert got[5] == ("safe", None, "")


def test_support_counts_artifacts_not_uris(spark):
    rows = [(1, "t", ["session://a/x@1#event=1"], ["s1"]), (2, "t", ["session://a/x@1#event=2"], ["s2"]), (3, "t", ["session://a/y@1#event=2"], ["s2"])]
    out = review.exact_dedup(spark.createDataFrame(rows, "n int, title string, evidence_uris array<string>, source_candidate_ids array<string>"), "n", ("title",), ("n",)).first()
    assert (out.n, out.support_count, out.source_candidate_ids, len(out.evidence_uris)) == (1, 2, ["s1", "s2"], 3)


def test_unknown_provenance_is_alone(spark):
    rows = spark.createDataFrame([(1, "?", 10), (2, None, 11), (3, "a", 12), (4, "a", 9)], "m int, a string, p int")
    out = groups.dependence_groups(rows, {"harness": F.lit("h"), "anchor": F.col("a")}, "m", "p").collect()
    assert sorted((r.members, r.representative) for r in out) == [([1], 10), ([2], 11), ([3, 4], 9)]


def test_hash_ranks(spark):
    rows = spark.createDataFrame([(s, f"{s}{k}") for s, n in (("a", 300), ("b", 7), (None, 3)) for k in range(n)], "s string, k string").withColumn("h", F.sha2(F.col("k"), 256))
    got = groups.hash_ranks(rows, "h", ["s"]).collect()
    for s in ("a", "b", None):
        mine = sorted((r for r in got if r.s == s), key=lambda r: r.h)
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1)) and all(r.n == len(mine) for r in mine)
    assert sorted(r["rank"] for r in groups.hash_ranks(rows, "h", []).collect()) == list(range(1, 311))


def test_window_reaches_the_scan(spark):
    from siftline.plans import catalogue

    plan = catalogue.queries()["census_window_counts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan and "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan
