"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest

from millrace import catalog, task_catalog  # noqa: F401 - the second registers its queries

DATA = os.environ.get("MILLRACE_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(v):
    if v is None:
        return "∅"
    if isinstance(v, decimal.Decimal):
        v = int(v) if v == int(v) else float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return v.isoformat()[:26].replace("+00:00", "") if hasattr(v, "isoformat") else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    rel = duck.sql(catalog.SQL[name])
    names = list(rel.columns)
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want
