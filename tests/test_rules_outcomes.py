import random

import pytest
from pyspark.sql import functions as F

from millrace import providers
from millrace.functions import scalars
from millrace.operators import cache, dedup, outcomes, rules, running, selection, state


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


RULES = {"language": 0.4, "stars": 0.3, "files": 0.25, "lines": 0.2, "docs": 0.3, "tests": 0.3, "description": 0.4, "build": 0.15}
SCHEMA = "language string, stars bigint, files_changed bigint, added_lines bigint, changed_files array<string>, title string, body string, score string, reasons string"


def test_rule_filter(spark):
    good = ("rust", 100, 2, 20, ["src/a.rs", "tests/b.rs"], "t" * 50, "b" * 50)
    bad = [
        ("cobol", 0, 1), ("unknown", 3, 1), (None, 0, 99), ("rust", 100, 2),
    ]
    data = [(*good, "x", "y"), *[(a, b, c, 1, ["README.md"], " ", None, "x", "y") for a, b, c in bad], ("rust", None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(data, SCHEMA).drop("score", "reasons")
    made = rules.change_rules(languages=["Rust"], min_stars=50, max_files=12, min_lines=5, max_lines=800, min_description=80, penalties=RULES)
    got = rules.rule_filter(df, made).collect()
    assert got[0]["accepted"] and got[0]["score"] == 1.0 and got[0]["reasons"] == []
    assert got[1]["reasons"] == ["language not listed: cobol", "lines below: 1", "all files are documentation", "description too short: 0", "no build files"]
    assert got[1]["score"] == 0.0 and got[2]["reasons"][0] == "stars below: 3" and got[3]["reasons"][0] == "files above: 99"
    assert got[4]["score"] == pytest.approx(1 - 0.2 - 0.3 - 0.4 + 0.05 - 0.15, abs=0.1)
    assert got[5]["reasons"] == ["description too short: 0"]  # nothing else is known of it
    assert rules.rule_filter(df.limit(0), made).count() == 0


def test_gate(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(["easy", "easy", "hard", None, "odd", None])], "i int, level string")
    assert rows(rules.level_gate(df, F.col("level"), ["i"], quotas={"easy": 1, "hard": 0}).select("i")) == [(0,), (3,), (5,)]
    assert rows(rules.level_gate(df, F.col("level"), ["i"], only="hard").select("i")) == [(2,), (3,), (5,)]
    assert rules.level_gate(df, F.col("level"), ["i"]).count() == 6
    assert rows(rules.first_rows(df, 2, [F.desc("i")]).select("i")) == [(4,), (5,)]


@pytest.mark.parametrize("seed", range(3))
def test_running_sums_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    data = [(i, rnd.choice(["hot", "hot", "hot", "a", None]), rnd.randint(-5, 9)) for i in range(500)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "i bigint, k string, v bigint").repartition(5)
    got = {r["i"]: r["s"] for r in running.running_sum(df, ["k"], ["i"], F.col("v"), "s").collect()}
    want, sums = {}, {}
    for i, k, v in sorted(data):
        sums[k] = sums.get(k, 0) + v
        want[i] = sums[k]
    assert got == want
    numbers = {r["i"]: r["n"] for r in running.row_numbers(df, [], ["i"], "n").collect()}
    assert numbers == {i: i + 1 for i in range(500)}
    models = {r["i"]: r["model"] for r in selection.round_robin(df, ["x", "y"], ["i"]).collect()}
    assert all(m == "xy"[i % 2] for i, m in models.items())
    assert {r["arm"] for r in selection.ab_arm(df, 0.9, ["i"], registered=False).collect()} == {"control"}
    assert running.running_sum(df.limit(0), ["k"], ["i"], F.col("v"), "s").count() == 0


def test_ttl_cache_equals_a_walk(spark):
    rnd = random.Random(4)
    data = [(rnd.choice(["hot", "hot", "b", None]), rnd.randint(0, 2000) * 1_000_000, i) for i in range(800)]
    got = {r["id"]: r["hit"] for r in cache.ttl_hits(spark.createDataFrame(data, "key string, at bigint, id bigint"), 60).collect()}
    alive, want = {}, {}
    for k, t, i in sorted(data, key=lambda r: (r[1], r[2])):
        k = k or ""
        want[i] = k in alive and t - alive[k] < 60_000_000
        if not want[i]:
            alive[k] = t
    assert got == want
    stats = cache.cache_stats(spark.createDataFrame([(h, 10) for h in want.values()], "hit boolean, tokens int"), "tokens").first()
    assert stats["hits"] == sum(want.values()) and stats["tokens_saved"] == 10 * stats["hits"] and stats["hit_rate"] == stats["hits"] / 800
    entries = spark.createDataFrame([("a", 0, 5), ("b", 90, 6), ("c", 95, 6), ("d", 95, 7)], "key string, created bigint, used bigint")
    assert {r[0] for r in cache.evicted(entries, 2, now=100_000_090, ttl_seconds=100).collect()} == {"a", "b"}
    assert {r[0] for r in cache.evicted(entries, 2).collect()} == {"a", "c"}


def test_first_seen(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], "i int, k string")
    assert {r["i"]: r["hit"] for r in state.first_seen(df, F.col("k"), ["i"]).collect()} == {1: False, 2: False, 3: True, 4: False, 5: True}


def test_outcomes(spark):
    tasks = spark.createDataFrame(
        [(k, "p" * 200, ["t"], p, []) for k, p in [("ok", "d"), ("early", "d"), ("empty", " "), ("apply", "d"), ("three", "d"), ("still", "d"), ("none", "d")]],
        "id string, prompt string, fail_to_pass array<string>, patch string, test_files array<string>",
    )
    facts = spark.createDataFrame(
        [
            ("ok", "base", "f2p", 1), ("ok", "apply", None, 1), ("ok", "apply", None, 0), ("ok", "after", "f2p", 0), ("early", "base", "f2p", 0),
            ("apply", "apply", None, 1), ("apply", "apply", None, 1), ("three", "apply", None, 0), ("three", "after", "p2p", 2), ("still", "after", "f2p", None),
        ],
        "task_id string, phase string, kind string, exit_code int",
    )
    got = dict(rows(outcomes.workspace_outcome(tasks, facts)))
    assert got == {"ok": "passed", "early": "passes before", "empty": "empty patch", "apply": "not applied", "three": "regression", "still": "still fails", "none": "passed"}
    took = dict(rows(outcomes.dual_commit(tasks, facts)))
    assert {k for k, v in took.items() if not v} == {"apply", "three", "still"}
    empty = outcomes.evaluation_summary(spark.createDataFrame([], "level string, success boolean, ms bigint")).first()
    assert (empty["status"], empty["success_rate"], empty["mean_ms"]) == ("failed", 0.0, 0)
    res = spark.createDataFrame([("Easy", True, 5), ("easy", False, 6), ("hard", True, 1), (None, True, 3)], "level string, success boolean, ms bigint")
    assert rows(outcomes.advice(res)) == [("easy tasks are too hard",), ("hard tasks are too easy",), ("well calibrated",)]
    assert outcomes.evaluation_summary(res).first()["mean_ms"] == 3
    with pytest.raises(ValueError):
        outcomes.pattern_hits(res.select(F.lit("x").alias("command")), spark.range(1001).select(F.col("id").cast("string").alias("pattern")))


def test_providers(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    told = spark.createDataFrame([("a", "x"), (None, "z")], "k string, answer string")
    assert rows(providers.answered(df, ["k"], providers.recorded(told), "t").select("k", "t")) == [("a", "x"), ("b", None), (None, "z")]
    assert providers.answered(df, ["k"], providers.recorded(told), "t", keep=False).count() == 2
    ask = providers.by_call(lambda pdf: pdf["n"].map(lambda n: f"n{n}"), ["n"])
    assert rows(providers.answered(df, ["k"], ask, "t").select("n", "t")) == [(1, "n1"), (2, "n2"), (3, "n3")]
    fails = providers.by_call(lambda pdf: 1 / 0, ["n"])
    assert rows(providers.answered(df, ["k"], fails, "t", F.lit("medium")).select("t").distinct()) == [("medium",)]


def test_ids_that_are_no_single_number(spark):
    ids = ["3f25-1", "3f25-1", "9e9a-2", "18446744073709551616", "18446744073709551616", "evt-007", "7", "evt-", "evt-", None, None]
    df = spark.createDataFrame([(x, "r", 1, "b", None, {"k": "v"}) for x in ids], "id string, repository string, pull_number bigint, batch_id string, ingested_at timestamp, m map<string,string>")
    kept = sorted(str(r["id"]) for r in dedup.keep_one(df).collect())
    assert len(kept) == 8 and kept.count("evt-") == 2 and kept.count("None") == 2 and kept.count("3f25-1") == 1
    assert rows(dedup.kept_messages(df).select("event_no", "copies")) == [(7, 2)]


@pytest.mark.parametrize("name, want", [("kimi-k2", True), ("akimi-k2", False), ("x kimi-k2.5", True), ("kimi-k2é", False), ("a-thinking", True), ("thinking", False), ("openai/o3", True)])
def test_models_that_reason(spark, name, want):
    assert spark.range(1).select(scalars.reasons(F.lit(name))).first()[0] is want
