"""Absent strata are those of no document at all."""

from siftline.plans import catalogue


def test_strata_of_high_ids_are_present(spark, tmp_path):
    rows = [(i, lang, 10) for i in range(40, 52) for lang in ("en", "de")]
    spark.createDataFrame(rows, "doc_id long, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in catalogue.queries()["absent_strata"](spark, str(tmp_path)).collect()}
    assert got == {("other", e, r) for e in ("interactive", "sdk") for r in ("root", "child")}
