"""Streams over files and folders of part files, against plain loops."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import SF

from siftline.plans import catalogue
from siftline.streaming import windows


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events as a folder of part files."""
    sf = str(tmp_path_factory.mktemp("sf"))
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(f"{sf}/events.parquet")
    return sf


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").collect()


def test_windows(spark, parts, events):
    want = Counter((r.ts.replace(minute=0, second=0, microsecond=0), r.event_type) for r in events)
    for sf in (SF, parts):
        got = catalogue.queries()["stream_window_counts"](spark, sf).collect()
        assert {(r.start, r.event_type): r.n for r in got} == want and len(got) == len(want)


def test_dedup(spark, parts, events):
    for sf in (SF, parts):
        got = catalogue.queries()["stream_dedup"](spark, sf).collect()
        assert sorted((r.event_id, r.user_id) for r in got) == sorted((r.event_id, r.user_id) for r in events)


def test_ledger(spark, parts, events):
    want, done, last, n = [], {}, {}, Counter()
    for r in sorted(events, key=lambda r: r.event_id):
        if not done.get(r.user_id):
            n[r.user_id] += 1
            done[r.user_id] = r.event_type != "error" or last.get(r.user_id) == "error"
            last[r.user_id] = r.event_type
            want.append((str(r.user_id), n[r.user_id], r.event_type, done[r.user_id]))
    for sf in (SF, parts):
        got = catalogue.queries()["stream_attempt_ledger"](spark, sf).collect()
        assert sorted(tuple(r) for r in got) == sorted(want)


def test_late_rows_are_counted_and_sessions_close(spark, tmp_path):
    at = datetime(2024, 1, 1)
    for k, minutes in enumerate([[0, 5, 9], [300, 301], [310], [311], [2, 302], [900]]):
        rows = [(at + timedelta(minutes=m), "a", 100 * k + m) for m in minutes]
        spark.createDataFrame(rows, "ts timestamp, kind string, id long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    stream = windows.stream_table(spark, f"{tmp_path}/t.parquet", files_per_trigger=1)
    counts = windows.windowed_counts(stream, "ts", "kind", "1 hour", "30 minutes")
    query = windows.run_updates(counts, f"{tmp_path}/counts", f"{tmp_path}/counts-state")
    got = {(r.start.hour, r.n) for r in windows.latest(spark, f"{tmp_path}/counts", ["start", "kind"], counts.schema).collect()}
    assert got == {(0, 3), (5, 5), (15, 1)} and windows.late_rows(query) == 1
    closed = windows.sessions(windows.stream_table(spark, f"{tmp_path}/t.parquet", files_per_trigger=1), "ts", "kind", "20 minutes", "30 minutes")
    windows.run_available(closed, f"{tmp_path}/sessions", f"{tmp_path}/sessions-state")
    got = {(r.start.hour, r.n) for r in spark.read.schema(closed.schema).parquet(f"{tmp_path}/sessions").collect()}
    assert (0, 3) in got


def test_restart_goes_on(spark, tmp_path):
    rows = [(1, 7, "error"), (2, 7, "error"), (3, 7, "view"), (4, 8, "view")]
    out = f"{tmp_path}/out"
    for part in (rows[:1], rows[1:]):
        spark.createDataFrame(part, "event_id long, user_id long, event_type string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/e.parquet")
        ledger = windows.attempt_ledger(windows.stream_table(spark, f"{tmp_path}/e.parquet"), "user_id", "event_id", "event_type", "error")
        windows.run_available(ledger, out, f"{tmp_path}/state")
    got = sorted(tuple(r) for r in spark.read.schema(ledger.schema).parquet(out).collect())
    assert got == [("7", 1, "error", False), ("7", 2, "error", True), ("8", 1, "view", True)]
