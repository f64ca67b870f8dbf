"""The command line from files to a page."""

import json

from siftline import cli


def test_census_to_groups(spark, tmp_path):
    root = tmp_path / "claude"
    root.mkdir()
    for k in range(3):
        rows = [{"type": "user", "sessionId": f"s{k}", "timestamp": f"2026-08-18T13:00:0{i}Z", "message": {"role": "user", "content": f"hello {k} {i}"}} for i in range(4)]
        (root / f"{k}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    window = ["--claude", str(root), "--start", "2026-08-16T20:00:00Z", "--cutoff", "2026-08-24T14:00:00Z"]
    out = lambda n: f"{tmp_path}/{n}"
    assert cli.main(["census", *window, "--out", out("census"), "--twice"], spark) == 0
    assert {r.status for r in spark.read.parquet(out("census") + "/manifest").collect()} == {"complete"}
    assert cli.main(["normalize", *window, "--out", out("packets")], spark) == 0
    receipt = {r.table: (r.rows, r.digest) for r in spark.read.json(out("packets") + "/receipt").collect()}
    assert set(receipt) == {"packets", "outcomes", "coverage", "summary", "reasons"} and receipt["packets"][0] == 3 and receipt["reasons"][0] == 0
    assert spark.read.parquet(out("packets") + "/packets").count() == 3
    assert spark.read.parquet(out("packets") + "/coverage").filter("disposition = 'packet'").count() == 12
    assert cli.main(["groups", "--census", out("census"), "--packets", out("packets"), "--out", out("groups")], spark) == 0
    assert spark.read.parquet(out("groups") + "/groups").count() == 3


def test_publish(spark, tmp_path):
    c = [(f"c{k}", f"t{k}", "x", "a", "seo", "finding", "[DATA]", 1) for k in range(3)]
    spark.createDataFrame(c, "candidate_id string, title string, content string, action string, topic string, learning_type string, claim_label string, support_count int").write.parquet(f"{tmp_path}/c")
    d = [("c0", "accept", None), ("c1", "reject", None), ("c2", "edit", "new <title>")]
    schema = "candidate_id string, decision string, title string, content string, action string, topic string, learning_type string"
    spark.createDataFrame([(*r, None, None, None, None) for r in d], schema).write.parquet(f"{tmp_path}/d")
    spark.createDataFrame([(*r, None, None, None, None) for r in d[:2]], schema).write.parquet(f"{tmp_path}/short")
    args = ["publish", "--candidates", f"{tmp_path}/c", "--out", f"{tmp_path}/o", "--page", f"{tmp_path}/page/p.html"]
    assert cli.main([*args, "--decisions", f"{tmp_path}/short"], spark) == 2
    assert cli.main([*args, "--decisions", f"{tmp_path}/d"], spark) == 0
    got = {r.candidate_id: r.title for r in spark.read.parquet(f"{tmp_path}/o/learnings").collect()}
    assert got == {"c0": "t0", "c2": "new <title>"}
    assert "new &lt;title&gt;" in (tmp_path / "page" / "p.html").read_text()
