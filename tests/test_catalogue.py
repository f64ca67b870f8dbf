"""Every query runs and equals its SQL."""

import pytest
from conftest import SF, same

from siftline.plans import catalogue

#: Tested in test_brute.
BRUTE = {"redacted_packets", "compact_packets", "pilot_assignment", "redact_full", "redact_phone", "high_entropy_secret", "injected_blocks"}
QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        same(df, duck, ORACLES[name])
    else:
        assert name in BRUTE, "a query without SQL needs a test in plain Python"


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
