"""Queries of the core against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not there")


def fold(x):
    if isinstance(x, float):
        return None if x != x else round(x, 6) + 0.0
    return float(x) if type(x).__name__ == "Decimal" else x


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - {"tree_levels", "tree_node_counts", "p1_paths"}))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    q = con.execute(entry.oracle_sql()[name])
    cols = sorted(c[0] for c in q.description)
    assert sorted(df.columns) == cols
    at = {c[0]: i for i, c in enumerate(q.description)}
    want = sorted(repr(tuple(fold(r[at[c]]) for c in cols)) for r in q.fetchall())
    assert sorted(repr(tuple(fold(r[c]) for c in cols)) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
