import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import dedup

SCHEMA = "id string, repository string, pull_number bigint, batch_id string, ingested_at timestamp, quotient string, row string"


def at(m):
    return dt.datetime(2025, 1, 1, 0, m)


ROWS = [
    ("evt-0012", "A/b ", 3, "b1", at(2), "x", "first"),
    (" EVT_12", "a/B", 3, "b2", at(1), "y", "second"),
    ("12", "a/b", 4, "b2", at(1), "z", None),
    ("12", "c/d", 3, "b2", None, None, None),
    ("12", "c/d", 3, "b2", None, None, None),
    ("evt-", "a/b", 3, "b1", at(1), None, None),
    ("evt-", "a/b", 3, "b1", at(1), None, None),
    (None, None, None, None, None, None, None),
    ("9" * 30, "a/b", 3, "b1", at(1), None, None),
    ("7", None, None, "b1", at(1), None, None),
    ("007", None, None, "b1", at(2), None, None),
]


def test_counts(spark):
    got = {tuple(r) for r in dedup.message_counts(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert got == {(12, "a/b", 3, 2), (12, "a/b", 4, 1), (12, "c/d", 3, 2), (7, None, None, 2)}


def test_keep_one_keeps_first_and_unnumbered(spark):
    kept = dedup.keep_one(spark.createDataFrame(ROWS, SCHEMA))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    rows = [tuple(r) for r in kept.collect()]
    assert len(rows) == 4 + 4
    assert [r[6] for r in rows if r[2] == 3 and r[3] == "b2" and (r[0] or "").endswith("12") and r[1] == "a/B"] == ["second"]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dedup.message_counts(empty).count() == 0
    assert dedup.keep_one(empty).count() == 0


@pytest.mark.parametrize("numbers", [[0, 1, -1, 2**63 - 1, -(2**63), 123456789012345]])
def test_permutation_is_exact(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    image = dedup.permute64(F.col("n"))
    got = df.select("n", image.alias("p"), dedup.unpermute64(image).alias("back")).collect()
    assert all(r["n"] == r["back"] for r in got)
    assert len({r["p"] for r in got}) == len(numbers)
