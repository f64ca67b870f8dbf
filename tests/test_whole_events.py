"""Rollup and delta take in every event."""

from conftest import SF, same

from siftline.plans import catalogue

BEFORE, INSIDE = "ts < TIMESTAMP '2024-01-08 00:00:00'", "ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 12:00:00'"


def test_usage_rollup(spark, duck):
    same(catalogue.queries()["usage_rollup"](spark, SF), duck, "SELECT user_id, count(*) AS parts, CASE WHEN bool_and(event_type <> 'error') THEN sum(event_id % 7) END AS total FROM events GROUP BY user_id")


def test_an_error_anywhere_leaves_no_total(spark, tmp_path):
    rows = [(1, 7, "click"), (11, 7, "view"), (12, 7, "error"), (13, 8, "view"), (22, 9, "view")]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in catalogue.queries()["usage_rollup"](spark, str(tmp_path)).select("user_id", "parts", "total").collect())
    assert got == [(7, 3, None), (8, 1, 6), (9, 1, 1)]


def test_cross_scan_delta(spark, duck):
    same(catalogue.queries()["cross_scan_delta"](spark, SF), duck, f"""
WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE {BEFORE} GROUP BY user_id), b AS (SELECT user_id, count(*) AS n FROM events WHERE {INSIDE} GROUP BY user_id)
SELECT count(*) FILTER (a.user_id IS NULL) AS added, count(*) FILTER (b.user_id IS NULL) AS removed, count(*) FILTER (a.n <> b.n) AS changed, count(*) FILTER (a.n = b.n) AS unchanged
FROM a FULL OUTER JOIN b ON a.user_id = b.user_id""")
