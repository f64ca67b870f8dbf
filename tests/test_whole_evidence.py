"""The evidence index takes in every event."""

from conftest import SF, same

from siftline.plans import catalogue


def test_every_event(spark, duck):
    same(catalogue.queries()["evidence_index"](spark, SF), duck, """
SELECT event_type, user_id % 10 AS pointer, CASE WHEN bool_and(value > 50) THEN 'observed' WHEN bool_or(value > 50) THEN 'unknown' ELSE 'asserted' END AS strength FROM events GROUP BY event_type, user_id % 10""")


def test_conflict_off_the_sample(spark, tmp_path):
    rows = [(13, 1, "view", 60.0), (14, 1, "view", 10.0), (15, 2, "view", 60.0), (16, 3, "view", 10.0)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in catalogue.queries()["evidence_index"](spark, str(tmp_path)).select("pointer", "strength").collect())
    assert got == [(1, "unknown"), (2, "observed"), (3, "asserted")]
