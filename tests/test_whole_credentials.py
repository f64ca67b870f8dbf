"""The credential scan applies all six rules."""

import re

from siftline.functions import lexicons as L
from siftline.plans import catalogue

TEXTS = ["session_token=abcdefghij0123456789", "csrf: ABCDEFGHIJKLMNOPQRST", "jwt = //abcdefghij0123456789", "cookie: short", "Bearer abcdefghijklmnopqrstuvwxyz and auth-id=abcdefghijklmnop", "plain", "sk-ant-abcdefghijklmnopqrstuvwx"]


def test_six_rules_as_re(spark, tmp_path):
    docs = [(20 * i, t) for i, t in enumerate(TEXTS)]  # ids that are given no made-up secret
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.rules for r in catalogue.queries()["credential_scan"](spark, str(tmp_path)).collect()}
    assert got == {i: sorted(name for name, p in L.CREDENTIALS if re.search(p, t)) for i, t in docs}
    assert "cookie_or_session_token" in got[0]
