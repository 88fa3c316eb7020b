"""Every training-data query with SQL gives the same rows as DuckDB on the smallest tables, and every other one runs."""

import os

import duckdb
import pytest

from millrace.llm import queries

DATA = os.environ.get("MILLRACE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    return f"{float(v):.6g}" if hasattr(v, "__float__") else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    rel = duck.sql(queries.SQL[name])
    names = list(rel.columns)
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() >= 0
