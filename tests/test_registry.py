"""Every query that has SQL against DuckDB, on the smallest data."""

import glob
import os

import duckdb
import pytest

from vellumry.plans import registry

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def _sorted(rows, cols):
    at = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DIR)
    r = duck.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in r.description]
    assert sorted(df.columns) == sorted(cols)
    assert _sorted([tuple(x) for x in df.collect()], df.columns) == _sorted(r.fetchall(), cols)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
