import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("OMP_NUM_THREADS", "1")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def normal(v):
    import decimal

    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (list, tuple)):
        return tuple(normal(x) for x in v)
    return v


def same(df, duck, sql):
    """Rows of a DataFrame and of SQL agree by column name, in any order."""
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(names)
    assert sorted(df.columns) == order
    want = sorted(repr(tuple(normal(r[names.index(c)]) for c in order)) for r in result.fetchall())
    got = sorted(repr(tuple(normal(r[c]) for c in order)) for r in df.collect())
    assert got == want
