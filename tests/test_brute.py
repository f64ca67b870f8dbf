"""Queries that SQL cannot say, row by row in plain Python; and small operators on small cases."""

import hashlib
import math
import re
from collections import Counter
from itertools import permutations

import pytest
from conftest import SF
from pyspark.sql import functions as F

from siftline.functions import blocks
from siftline.functions import lexicons as L
from siftline.operators import estimate, probe
from siftline.plans import catalogue, runs

Q = catalogue.queries()


def redacted(text, rules):
    count = 0
    for _, pattern, by in rules:
        text, n = re.subn(pattern, by, text)
        count += n
    return text, count


def escaped(text):
    return re.sub(r"&(?!(?:amp|lt|gt|quot|#[0-9]+|#x[0-9a-fA-F]+);)", "&amp;", text).replace("<", "&lt;").replace(">", "&gt;")


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """The documents, and some in which every rule has something to find."""
    sf = str(tmp_path_factory.mktemp("sf"))
    hard = [
        "mail a.b@c.de, call +49 (0)30 1234567 or 030/12 34 56 78 90", "see /Users/me/x.txt or /tmp/abc, http://x/Users/y", "Customer: John Smith; name = Ada Lovelace Byron", "internal id: AB-12 proprietary_code=zz.9",
        "token: " + "aZ3kd92jfKd82jdK2ls9Qw8eRt5yU1iO", "secret=" + "a" * 40, "password " + hashlib.sha256(b"x").hexdigest(), "a & b &amp; <script> &lt;", "", "name: lower case", "x@y", "2024-01-01 12:00:00",
    ]
    extra = spark.createDataFrame([(10_000_000 + i, t) for i, t in enumerate(hard)] + [(20_000_000, None)], "doc_id long, text string")
    spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(extra).write.parquet(f"{sf}/documents.parquet")
    return sf


def test_redact_full(spark, documents):
    rows = spark.read.parquet(f"{documents}/documents.parquet").collect()
    want = {}
    for r in rows:
        text, n = redacted(r.text, L.REDACTIONS) if r.text is not None else (None, 0)
        want[r.doc_id] = (escaped(text) if text is not None else None, n)
    assert {r.doc_id: (r.redacted, r.redactions) for r in Q["redact_full"](spark, documents).collect()} == want
    assert sum(n for _, n in want.values()) > 5


def test_redact_phone(spark, documents):
    rows = spark.read.parquet(f"{documents}/documents.parquet").collect()
    want = {r.doc_id: redacted(r.text, L.REDACTIONS[1:2]) for r in rows if r.text and redacted(r.text, L.REDACTIONS[1:2])[1]}
    assert {r.doc_id: (r.redacted, r.redactions) for r in Q["redact_phone"](spark, documents).collect()} == want and want


def test_high_entropy_secret(spark, documents):
    def bits(value):
        return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())

    def found(text):
        for m in re.finditer(L.SECRET_TOKEN, text or ""):
            before = text[max(0, m.start() - L.SECRET_PREFIX) : m.start()]
            if len(m[0]) >= L.SECRET_LENGTH and not any(re.fullmatch(p, m[0]) for p in L.SECRET_OVERRIDES) and re.search(L.SECRET_CONTEXT, before) and bits(m[0]) >= L.SECRET_ENTROPY:
                return True
        return False

    want = {r.doc_id: found(r.text) for r in spark.read.parquet(f"{documents}/documents.parquet").collect()}
    assert {r.doc_id: r.secret for r in Q["high_entropy_secret"](spark, documents).collect()} == want and any(want.values())


def test_injected_blocks(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = Counter(blocks.fingerprint(b) for r in pages for b in re.findall(r"(?s)<script>.*?</script>", r.html or ""))
    known = {d for d, _ in sorted(found.items(), key=lambda x: (-x[1], x[0]))[:20]}
    look = blocks.Inspector([blocks.Rule("<script>", "</script>", frozenset(known))])
    want = {}
    for r in pages:
        x = look(r.html)
        want[r.page_id] = ("quarantined" if x.reason else "safe", x.reason, len(x.fingerprints), None if x.remaining is None else len(x.remaining))
    assert {r.page_id: (r.status, r.reason, r.excluded, r.remaining_chars) for r in Q["injected_blocks"](spark, SF).collect()} == want


def test_redacted_and_compact_packets(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    talks = {}
    for r in sorted(turns, key=lambda r: r.turn):
        talks.setdefault(f"c{r.conv_id}", []).append(r)
    safe = {a: rows for a, rows in talks.items() if not any(r.role == "system" and r.text.strip() for r in rows)}
    got = {}
    for r in Q["redacted_packets"](spark, SF).collect():
        got.setdefault(r.artifact_id, []).append(r)
        assert r.bytes <= 8192 and r.tokens == (r.bytes + 2) // 3
    assert {a: sum(r.n_events for r in rows) for a, rows in got.items()} == {a: len(rows) for a, rows in safe.items()}
    compact = {r.packet_id: r.n_events for r in Q["compact_packets"](spark, SF).collect()}
    assert compact and all(n >= 1 for n in compact.values())


def test_pilot_assignment_costs_least(spark):
    """No two slots can trade or replace their packets for less; on a small part, against every assignment."""
    costs = {}
    for r in Q["pilot_cost_matrix"](spark, SF).collect():
        costs.setdefault(r.slot_id, {})[r.packet_id] = r.cost
    chosen = {r.slot_id: r.packet_id for r in Q["pilot_assignment"](spark, SF).collect()}
    assert len(chosen) == 24 == len(set(chosen.values()))
    free = set(next(iter(costs.values()))) - set(chosen.values())
    for s, p in chosen.items():
        assert costs[s][p] <= min(costs[s][x] for x in free)
        for t, q in chosen.items():
            assert costs[s][p] + costs[t][q] <= costs[s][q] + costs[t][p]
    some = sorted(chosen)[:6]
    own = [chosen[s] for s in some]
    assert sum(costs[s][p] for s, p in zip(some, own)) == min(sum(costs[s][p] for s, p in zip(some, ps)) for ps in permutations(own))


def test_select_roots(spark):
    rows = [("a", "root", None, 3, 9), ("b", "root", None, 3, 10), ("c", "child", None, 9, 9), ("d", "root", "p", 9, 9), ("e", "root", None, 4, 1)]
    df = spark.createDataFrame(rows, "artifact_id string, source_kind string, parent_artifact_id string, marketing_events int, events int")
    assert [r.artifact_id for r in probe.select_roots(df, 3, 3).collect()] == ["e", "b", "a"]
    with pytest.raises(ValueError):
        probe.select_roots(df)
    flags = spark.createDataFrame([("a", None), ("b", False)], "artifact_id string, sidechain boolean")
    assert probe.refuse_sidechains(flags).count() == 2
    with pytest.raises(ValueError, match="non_root_source:c"):
        probe.refuse_sidechains(flags.unionByName(spark.createDataFrame([("c", True)], flags.schema)))


def test_observed_minutes(spark):
    files = spark.createDataFrame([("2026-01-01 00:02:00.5",), ("2026-01-01 00:01:00",)], "m string").select(F.col("m").cast("timestamp").alias("modified"))
    start = F.lit("2026-01-01 00:00:00").cast("timestamp")
    assert tuple(estimate.observed_minutes(files, start).first()) == (121, 3)
    assert tuple(estimate.observed_minutes(files, F.lit("2027-01-01").cast("timestamp")).first()) == (1, 1) and estimate.observed_minutes(files.limit(0), start).first() is None


def test_claims_from_data_need_strengths(spark):
    row = {"id": "x", "title": "t", "content": "increase budget for audience x", "label": "[DATA]", "topic": "seo", "type": "finding", "decision": "shift budget", "evidence": ["session://claude/a@1#event=e"]}
    base = spark.createDataFrame([("b", "other words here")], "id string, text string")
    rows = spark.createDataFrame([row, {**row, "id": "y", "label": "[LOGIC]"}], runs.CANDIDATE)
    assert {r.id: r.reason for r in runs.decide(rows, base, None).collect()} == {"x": "data_evidence_strength_unavailable", "y": "accepted"}


def test_novelty_ranks_ids_as_text(spark):
    words = ["one", "two", "three", "four", "five"]
    c = spark.createDataFrame([("c", words), ("d", [*words, "six"]), ("e", ["none"])], "k string, tokens array<string>")
    b = spark.createDataFrame([("b", words), ("aa", words), ("10", words[:4])], "id string, tokens array<string>")
    assert {r.k: r.outcome for r in probe.novelty(c, b, "k").collect()} == {"c": "semantic_baseline_match:10", "d": "semantic_baseline_match:10", "e": "novel"}
    rest = {r.k: r.outcome for r in probe.novelty(c, b.filter("id <> '10'"), "k").collect()}
    assert rest == {"c": "exact_baseline_match:aa", "d": "semantic_baseline_match:aa", "e": "novel"}


def test_batches_with_a_reserve(spark):
    from siftline.operators import packing

    rows = [("a", k, "x" * n) for k, n in enumerate([10, 10, 100, 5, 5])]
    df = spark.createDataFrame(rows, "h string, k int, p string")
    got = {r.k: r.batch for r in packing.reserved_batches(df, "h", ["k"], "p", 60, 10).collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 3, 4: 3}  # the third is too large, and not measured alone
    for bad in (df.filter("k >= 2"), None):
        with pytest.raises(ValueError):
            packing.reserved_batches(bad if bad is not None else df, "h", ["k"], "p", 60, 10 if bad is not None else 60)


def test_an_answer_is_kept_before_anything_else(spark, tmp_path):
    from siftline.operators import provider

    items = spark.createDataFrame([("b1", "w1", "p"), ("b1", "w2", "q"), ("b2", "w3", "r")], "batch_id string, work_item_id string, payload string")
    calls = str(tmp_path / "calls")

    def runner(payloads):
        with open(calls, "a") as f:
            f.write("x")
        return [p.upper() for p in payloads]

    store = f"file://{tmp_path}/answers"
    want = [("w1", "complete", "P"), ("w2", "complete", "Q"), ("w3", "complete", "R")]
    for _ in range(2):
        assert sorted((r.work_item_id, r.status, r.result) for r in provider.run_batches(items, runner, store=store).collect()) == want
    assert open(calls).read() == "xx"
