"""Every registered query that has SQL gives DuckDB's rows at the smallest size."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from quirework.plans.queries import QUERIES, bound

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the supplied tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(x):
    if x is None or x is pd.NA or x != x:
        return None
    if isinstance(x, bool) or type(x).__name__ == "bool_":
        return bool(x)
    if hasattr(x, "is_integer") or hasattr(x, "__index__"):
        return int(x) if float(x).is_integer() else float(x)
    return x


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(str(tuple(map(plain, r))) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_same_rows(spark, db, name):
    got, want = bound(QUERIES[name])(spark, DATA).toPandas(), db.sql(QUERIES[name].sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["image", "volume", "chars", "words", "sparse"] and out.count() == 200
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_demo(spark):
    out = entry.demo(spark, DATA).toPandas()
    assert out.error.isna().all()
    even = out[out.source_key.map(lambda k: int(k.split(".")[0]) % 2 == 0)]
    assert set(even.label) == {"A", "B"} and set(out[~out.index.isin(even.index)].label) == {""}
