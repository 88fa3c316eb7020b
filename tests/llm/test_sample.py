import pytest
from pyspark.sql import functions as F

from millrace.llm import sample

TARGETS = [(1, "difficulty", "Easy ", 0.5, 2), (2, "difficulty", "hard", 0.5, 2), (3, "language", "go", 0.9, 1), (4, "language", "zig", 0.1, 3)]
T_SCHEMA = "target_id int, dim string, category string, target_share double, min_rows int"
R_SCHEMA = "instance_id string, difficulty string, language string, cell string, draw int"


def rows(spark, n, hard=40):
    data = [(f"i{i}", "hard" if i < hard else (" EASY", "easy", None, "")[i % 4], "Go" if i % 3 else "zig ", "c", i) for i in range(n)]
    return spark.createDataFrame(data, R_SCHEMA)


def test_largest_remainder():
    q = sample.largest_remainder({"a": 0.5, "b": 0.3, "c": 0.2}, 10, {"c": 4}, {"a": 100, "b": 100, "c": 100})
    assert q == {"a": 4, "b": 2, "c": 4} and sum(q.values()) == 10
    assert sample.largest_remainder({"a": 0.5, "b": 0.5}, 11, {}, {"a": 3, "b": 100}) == {"a": 3, "b": 8}
    assert sum(sample.largest_remainder({"a": 1 / 3, "b": 1 / 3, "c": 1 / 3}, 10, {}, dict.fromkeys("abc", 99)).values()) == 10
    assert sample.largest_remainder({}, 5, {}, {}) == {}


def test_report_and_sample(spark):
    df, t = rows(spark, 400), spark.createDataFrame(TARGETS, T_SCHEMA)
    rep = {r["target_id"]: r for r in sample.report(df, t).collect()}
    assert rep[2]["available"] == 40 and rep[2]["needed"] == pytest.approx(60.0) and rep[2]["unmet"]
    assert not rep[1]["unmet"] and rep[1]["available"] == 180
    drawn = sample.sample(df, t)
    assert drawn.columns == df.columns
    got = {r[0]: r[1] for r in drawn.groupBy(F.lower(F.trim("difficulty"))).agg(F.count("*")).collect()}
    assert got == {"hard": rep[2]["sampled"], "easy": rep[1]["sampled"]}
    assert 36 <= got["hard"] <= 40 and abs(sum(got.values()) - 120) <= 6
    again = {r["instance_id"] for r in sample.sample(df.orderBy(F.desc("instance_id")), t).collect()}
    assert again == {r["instance_id"] for r in drawn.collect()}


def test_empty(spark):
    df, t = rows(spark, 0), spark.createDataFrame(TARGETS, T_SCHEMA)
    assert all(r["unmet"] for r in sample.report(df, t).collect())
    assert sample.sample(df, t).count() == 0


def test_rows_of_one_category_fill_its_quota(spark):
    t = spark.createDataFrame(TARGETS, T_SCHEMA)
    data = [(f"h{i}", "hard", None if i % 2 else "cobol", "c", i) for i in range(40)]
    data += [(f"e{i}", "easy", "go", "c", i) for i in range(300)] + [(f"z{i}", "", "zig", "c", i) for i in range(60)]
    df = spark.createDataFrame(data, R_SCHEMA)
    rep = {(r["dim"], r["category"]): r for r in sample.report(df, t).collect()}
    assert {k[1]: r["sampled"] for k, r in rep.items()} == {"hard": 40, "easy": 80, "go": 80, "zig": 12}
    assert {k[1] for k, r in rep.items() if r["missed"]} == {"hard", "go"} and rep["difficulty", "hard"]["unmet"]
    assert not rep["language", "go"]["unmet"]
    drawn = sample.sample(df, t)
    assert {r[0]: r[1] for r in drawn.groupBy("difficulty").count().collect()} == {"hard": 40, "easy": 80, "": 12}


def test_allocate_keeps_minimums():
    cells = {("easy", "go"): 500, ("hard", sample.OTHER): 90, ("hard", "go"): 4, (sample.OTHER, "zig"): 70, (sample.OTHER, sample.OTHER): 336}
    got = sample.allocate(cells, [{"easy": 0.9, "hard": 0.1}, {"go": 0.9, "zig": 0.1}], [{"hard": 50}, {"zig": 60}], 300)
    assert got[("easy", "go")] == 236 and got[("hard", "go")] == 4
    assert got[("hard", sample.OTHER)] == 46 and got[(sample.OTHER, "zig")] == 60 and (sample.OTHER, sample.OTHER) not in got
    assert sample.allocate({(): 5}, [], [], 1) == {}
