import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import bisect, cap

SCHEMA = "row_id bigint, repo string, pr_number bigint, quality_score double, contributor string, rank_id string"


def brute(data, limit):
    groups = {}
    for r in data:
        groups.setdefault((r[1] or "").strip().lower(), []).append(r)
    gone = set()
    for rows in groups.values():
        def key(r):
            s = r[3]
            bad = s is None or s != s
            return (1.0 if bad else -min(max(s, 0.0), 1.0), r[2] if r[2] is not None else 1 << 62, r[0])
        gone |= {r[0] for r in sorted(rows, key=key)[limit:]}
    return gone


def table(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        repo = rnd.choice(["Big/repo", " big/REPO", "big/repo", "a/b", "c/d", None, f"x/{i}"])
        score = rnd.choice([None, float("nan"), -1.0, 2.0, 0.5, 0.5, 1e-300, rnd.random(), 0.0, -0.0])
        out.append((i, repo, rnd.choice([None, 1, 2, 3, i]), score, "c", "r"))
    return out


@pytest.mark.parametrize("limit, seed", [(1, 1), (7, 2), (40, 3), (10_000, 4)])
def test_cap_equals_brute_force(spark, limit, seed):
    data = table(400, seed)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["rank_id"] for r in cap.over_cap(df, max_rows=limit).collect()}
    assert got == brute(data, limit)
    kept = cap.cap_per_contributor(df, max_rows=limit)
    assert kept.columns == df.columns or set(kept.columns) == set(df.columns)
    assert kept.count() == 400 - len(got)


def test_share_and_empty(spark):
    data = table(200, 9)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r["rank_id"] for r in cap.over_cap(df, share=0.02).collect()}
    assert got == brute(data, 4)
    assert cap.over_cap(df.limit(0), share=0.02).count() == 0
    with pytest.raises(ValueError):
        cap.over_cap(df)


def test_equal_rows_share_a_fate(spark):
    df = spark.createDataFrame([("g", 5, 5)] * 4, "g string, a bigint, b bigint")
    q = spark.createDataFrame([("g", 2)], "g string, quota bigint")
    cuts = bisect.cutoffs(df, "g", ["a", "b"], q)
    assert [tuple(r) for r in cuts.collect()] == [("g", 5, 5)]
    assert df.join(cuts, "g").where(bisect.beyond(["a", "b"])).count() == 0
    assert bisect.cutoffs(df, "g", ["a"], q.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("first, step", [(1 << 61, 1), (-(1 << 63), (1 << 57)), ((1 << 63) - 101, 1)])
def test_large_keys(spark, first, step):
    rows = [(first + i * step, "a/b", 7, 0.5, "c", "r") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["rank_id"] for r in cap.over_cap(df, max_rows=40).collect()}
    assert got == {first + i * step for i in range(40, 100)}
