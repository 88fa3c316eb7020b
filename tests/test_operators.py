import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import reports, selection, state
from millrace.plans import dataset
from millrace.sources import events, tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_log_keeps_older_values(spark):
    log = spark.createDataFrame(
        [(1, "a", "t", "easy", "enriched"), (2, "a", None, "hard", "scored"), (3, "a", None, None, None), (1, "b", None, None, "x")],
        "seq int, k string, title string, level string, status string",
    )
    assert rows(state.merge_log(log, ["k"], "seq")) == [("a", "t", "hard", None, 1, 3), ("b", None, None, "x", 1, 1)]


def test_upsert_and_mark(spark):
    old = spark.createDataFrame([("a", "t", "new", None), ("b", "u", "new", "r")], "k string, title string, status string, rejection_reason string")
    new = spark.createDataFrame([("a", None, "done", None), ("c", "v", "new", None)], old.schema)
    merged = state.upsert(old, new, ["k"])
    assert rows(merged.select("k", "title", "status")) == [("a", "t", "done"), ("b", "u", "new"), ("c", "v", "new")]
    marks = spark.createDataFrame([("b", None), ("zz", "why")], "k string, rejection_reason string")
    assert rows(state.mark(old, marks, ["k"], "rejected"))[1] == ("b", "u", "rejected", "r")


def test_histogram_of_empty_table(spark):
    empty = spark.createDataFrame([], "status string")
    assert tuple(state.status_histogram(empty, ["x"]).first()) == (0, 0)


def test_shards_are_full_and_in_order(spark):
    df = spark.range(1003).select(F.format_string("id-%05d", "id").alias("k"))
    got = selection.number_shards(df, 50, ["k"]).groupBy("shard").agg(F.count("*").alias("n"), F.min("k").alias("lo")).orderBy("shard").collect()
    assert [r["n"] for r in got] == [50] * 20 + [3]
    assert [r["lo"] for r in got] == [f"id-{i:05d}" for i in range(0, 1003, 50)]


def test_run_status(spark):
    f = [("s", "setup", None, 1, ""), ("i", "base", "f2p", 0, ""), ("t", "base", "f2p", 1, ""), ("t", "agent", None, 1, "Timeout!"),
         ("r", "base", "f2p", 1, ""), ("r", "after", "f2p", 0, None), ("u", "base", "p2p", 0, ""), ("u", "after", "p2p", 2, "")]
    facts = spark.createDataFrame(f, "task_id string, phase string, kind string, exit_code int, stderr string")
    got = {r["task_id"]: r["status"] for r in reports.run_status(facts).collect()}
    assert got == {"s": "setup_error", "i": "sanity_fail", "t": "agent_error", "r": "resolved", "u": "unresolved"}


def test_process_score(spark):
    r = [("a", "ls", 1.0, 0), ("a", "rm -rf x", 9.0, 1), ("b", "grep x", 1.0, 0)]
    runs = spark.createDataFrame(r, "run_id string, command string, duration double, exit_code int")
    got = reports.process_validation(runs, ["^ls", "grep"], ["rm -rf"], min_commands=2, max_single=5.0, all_success=True)
    a, b = sorted(got.collect(), key=lambda x: x["run_id"])
    assert (a["valid"], a["issues"]) == (False, 4)
    assert a["score"] == pytest.approx(0.5 * 0.5 * 0.9**2)
    assert b["score"] == pytest.approx(0.5 * 0.9)


def test_file_checks(spark):
    files = spark.createDataFrame([("t", "a.txt", "one\ntwo\n"), ("t", "b.json", "{}")], "task_id string, path string, content string")
    c = [("1", "exists", "a.txt", None), ("2", "exists", "no", None), ("3", "not_contains", "no", "x"), ("4", "line_count", "a.txt", "2"),
         ("5", "line_count", "a.txt", "3"), ("6", "json_valid", "b.json", None), ("7", "regex", "a.txt", "^one"), ("8", "odd", "a.txt", None)]
    checks = spark.createDataFrame([("t", i, k, p, e, True) for i, k, p, e in c], "task_id string, check_id string, kind string, target string, expected string, required boolean")
    got = {r["check_id"]: r["passed"] for r in reports.file_checks(files, checks).collect()}
    assert got == {"1": True, "2": False, "3": True, "4": True, "5": False, "6": True, "7": True, "8": False}


def test_dump_lines(spark):
    lines = [
        '{"type": "E", "id": 5, "actor": {"login": "me"}, "org": null, "created_at": "2025-01-02T03:04:05Z", "payload": '
        '{"action": "closed", "pull_request": {"merged": true, "number": 3, "title": "T"}, "repository": {"watchers_count": 99999999999}}}',
        "{broken", '{"type": "E"} tail', '{"id": 1}', "", '{"type": "I", "payload": {"issue": {"number": 8}}}',
    ]
    got = events.normalize_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r["event_type"], r["action"], r["pull_number"], r["stars"], r["has_org"]) for r in got] == [
        ("E", "merged", 3, 0, True),
        ("I", "unknown", 8, 0, False),
    ]


def _tasks(spark):
    meta = {"difficulty": "easy", "test_files": json.dumps([{"path": "a/t.py", "content": "1"}, {"path": "b/t.py", "content": "2"}])}
    data = [("o/r-7", "o/r", "c", "", "rust", 2, "p", "", ["cmd1"], ["cmd2"], meta, "do it", "", 0.5, True)]
    return spark.createDataFrame(
        data,
        "id string, repo string, base_commit string, merge_commit string, language string, difficulty_score smallint, patch string, test_patch string,"
        "fail_to_pass array<string>, pass_to_pass array<string>, meta map<string,string>, prompt string, original_pr_body string,"
        "quality_score double, quality_passed boolean",
    ).withColumn("created_at", F.lit("2025-01-01 00:00:00").cast("timestamp"))


def test_export_round_trip(spark, tmp_path):
    out = dataset.export_projection(_tasks(spark))
    assert len(out.columns) == 16 and out.first()["test_patch"] is None
    dataset.write_parquet(out, str(tmp_path / "train.parquet"))
    back = tables.read_dataset(spark, str(tmp_path)).first()
    assert (back["id"], back["fail_to_pass"], back["difficulty_score"], back["test_patch"]) == ("o/r-7", ["cmd1"], 2, "")
    with pytest.raises(ValueError):
        dataset.write_parquet(out.limit(0), str(tmp_path / "none"))


def test_missing_columns_are_null(spark):
    odd = spark.createDataFrame([("i", "r", "[broken", "x")], "instance_id string, REPO string, fail_to_pass string, quality_score string")
    r = tables.dataset_tasks(odd).first()
    assert (r["repo"], r["fail_to_pass"], r["difficulty_score"], r["quality_score"]) == ("r", [], 1, None)


def test_task_folders(spark, tmp_path):
    dataset.write_task_folders(_tasks(spark), str(tmp_path))
    root = tmp_path / "o" / "r-7"
    assert (root / "checks.txt").read_text() == "cmd1\ncmd2"
    assert sorted(os.listdir(root / "tests")) == ["1_t.py", "fail_to_pass_1.sh", "pass_to_pass_1.sh", "t.py"]
    assert (root / "tests" / "fail_to_pass_1.sh").read_text().endswith("\ncmd1\n")
    assert (root / "prompt.md").read_text().startswith("# o/r-7\n\n")
    import yaml

    assert yaml.safe_load((root / "workspace.yaml").read_text())["id"] == "o/r-7"
    out = rows(dataset.reexport(spark, str(tmp_path), str(tmp_path / "copy")))
    assert out == [("o/r-7", 3, 0)] and (tmp_path / "copy" / "o" / "r-7" / "checks.txt").exists()


def test_finalize_and_shards(spark, tmp_path):
    rows_ = spark.range(7).select(F.col("id").cast("string").alias("instance_id"), F.when(F.col("id") > 3, "hard").alias("difficulty"))
    assert rows(dataset.finalize(rows_, str(tmp_path))) == [("hard", 3), ("unknown", 4)]
    dataset.write_shards(rows_, str(tmp_path / "s"), size=3)
    assert len([x for x in os.listdir(tmp_path / "s") if x.startswith("shard=")]) == 3
    dataset.write_shards(rows_, str(tmp_path / "s"), size=4, start=3)
    assert len([x for x in os.listdir(tmp_path / "s") if x.startswith("shard=")]) == 5
    assert spark.read.parquet(str(tmp_path / "hard.parquet")).count() == 3
    assert tables.locate_dataset(spark, str(tmp_path)) == [f"file:{tmp_path}/train.parquet"]
    assert tables.locate_dataset(spark, str(tmp_path), "hard") == [f"file:{tmp_path}/hard.parquet"]
    assert tables.locate_dataset(spark, str(tmp_path / "train.parquet")) == [str(tmp_path / "train.parquet")]
    assert "instance_id" in dataset.card(rows_, "x")


def test_skip_list_and_yaml(spark, tmp_path):
    p = tmp_path / "skip.jsonl"
    p.write_text('{"repo": "a", "pr": 1}\n\nbad\n{"repo": "a", "pr": 1}\n{"repo": "b"}\n')
    assert rows(tables.read_skip_list(spark, str(p))) == [("a", 1)]
    assert tables.read_skip_list(spark, str(tmp_path / "no")).count() == 0
    (tmp_path / "o" / "r-1").mkdir(parents=True)
    (tmp_path / "o" / "r-1" / "workspace.yaml").write_text("id: x\nn: 2\n")
    (tmp_path / "o" / "workspace.yaml").write_text("][")
    (tmp_path / "o" / "task.yaml").write_text("id: t\nsuccess_criteria: [a, b]\nverification:\n  automated_checks: [{type: exists, target: x}]\n")
    (tmp_path / "o" / "r-1" / "task.yaml").write_text("verification: {partial_credit_criteria: [{criterion: c, points: 0.5}]}\n")
    assert rows(tables.read_task_files(spark, str(tmp_path))) == [("t", "", "medium", "", ["a", "b"])]
    checks, credits = tables.read_verification(spark, str(tmp_path))
    assert rows(checks.drop("path")) == [("exists", "x", None, True)] and rows(credits.drop("path")) == [("c", 0.5, None, None)]
    got = tables.read_yaml(spark, str(tmp_path)).collect()
    assert [json.loads(r["json"]) for r in got] == [{"id": "x", "n": 2}]


def test_seeded_sample_and_merge(spark):
    df = spark.range(100)
    assert rows(selection.seeded_sample(df, 10, 1, "id")) == rows(selection.seeded_sample(df.orderBy(F.desc("id")), 10, 1, "id"))
    t = "array<struct<path:string,content:string>>"
    two = spark.createDataFrame([([("a", "1")], [("a", "2"), ("b", "3")])], f"x {t}, y {t}")
    assert [tuple(f) for f in two.select(selection.merge_files(F.col("x"), F.col("y"))).first()[0]] == [("a", "1"), ("b", "3")]


def test_hours(spark, tmp_path):
    import gzip

    from millrace.sources import events

    with gzip.open(tmp_path / "2025-01-01-3.json.gz", "wt") as f:
        f.write('{"type": "A", "id": "1", "note": "if (x) {} {y}"}\nbad\n')
    (tmp_path / "2025-01-01-4.json.gz").write_bytes(b"damaged")
    got = events.read_hours(spark, str(tmp_path), ["2025-01-01-3", "2025-01-01-4", "2025-01-01-5"])
    assert rows(got.select("id", "event_type")) == [("1", "A")]
    with pytest.raises(ValueError):
        events.read_hours(spark, str(tmp_path), ["2025-01-01-5"])


def test_find_with_a_high_limit(spark):
    files = spark.range(1).select(F.lit("f").alias("path"), F.repeat(F.lit("hit\n"), 6000).alias("content"))
    assert tables.find_in_files(files, "hit", 5000).count() == 5000


def test_valid_objects(spark):
    from millrace.sources import events

    good = ['{"a":"if (x) {} {y}"}', '{"note":"x}y"}', '{"a":"q\\"} {"}', ' {"a":{"b":[{}]}} ', "{}", '{"a":"' + "\\n" * 20000 + '"}']
    bad = ['{"a":1} x', '{"a":1}}', '{"a":1},{"b":2}', '{"a":1}] x', '{"a":1}}] x', "[1]", "", '{"a"', None]
    df = spark.createDataFrame([(x,) for x in good + bad], "value string")
    assert {r[0] for r in df.where(events.valid_object(F.col("value"))).collect()} == set(good)


def test_release(spark):
    from millrace import runtime

    df = runtime.materialize(spark.range(3), "gone")
    assert df.count() == 3
    runtime.release(spark)
    assert not runtime.exists(spark, f"{runtime.shared_dir(spark)}/{runtime._RUN}")


def test_commands(spark, tmp_path):
    from millrace import cli

    changes = [("o/r ", n, "t", "b", "rust", "x", "m", 1, 2, 0, {"difficulty": "easy"}) for n in range(1, 6)]
    schema = "repository string, number bigint, title string, body string, language string, base_sha string, merge_sha string, files_changed bigint, added_lines bigint, removed_lines bigint, metadata map<string,string>"
    spark.createDataFrame(changes, schema).write.parquet(str(tmp_path / "c"))
    spark.createDataFrame([("O/r", n, "diff --git a/x.rs b/x.rs\n+a\n") for n in range(1, 6)], "repo string, pr_number bigint, patch string").write.parquet(str(tmp_path / "d"))
    (tmp_path / "skip").write_text('{"repo": "o/R", "pr": 1}\n')
    say = lambda *a: cli.main([str(x) for x in a], spark)
    args = ("mine", tmp_path / "c", tmp_path / "d", tmp_path / "t", "--skip", tmp_path / "skip")
    assert say(*args, "--count", 9)["tasks"] == 4 and say(*args, "--quotas", "easy:2")["tasks"] == 2
    assert say("mine", tmp_path / "c", tmp_path / "d", tmp_path / "none", "--quotas", "hard:2")["status"] == "failed"
    spark.createDataFrame([("a", True, 4), ("hard", False, 5)], "level string, success boolean, ms bigint").write.parquet(str(tmp_path / "e"))
    assert say("evaluate", tmp_path / "e")["levels"][1] == {"level": "medium", "tasks": 1, "success_rate": 1.0, "mean_ms": 4}
    spark.createDataFrame([("r", None), (None, "x")], "status string, repo string").write.parquet(str(tmp_path / "s"))
    assert say("benchmark", tmp_path / "s") == {"total": 2, "r": 1}
    facts = "task_id string, phase string, kind string, exit_code int, stderr string, seconds double"
    spark.createDataFrame([("1", "base", "f2p", 1, None, 0.0), ("1", "agent", None, 0, None, 7.25), ("1", "after", "f2p", 0, None, 0.0)], facts).write.parquet(str(tmp_path / "f"))
    got = say("harness", tmp_path / "f")
    assert got["resolved"] == 1 and got["mean_agent_seconds"] == pytest.approx(7.3)
    exported = spark.createDataFrame([("i", "r", "Go", 2)], "instance_id string, repo string, language string, difficulty_score int")
    exported.write.parquet(str(tmp_path / "x"))
    assert say("load", tmp_path / "x")["languages"] == [{"value": "go", "n": 1}]
    task = [("o-1", "p" * 150, ["t"], [], "diff", {"k": "Rust"}, "go", "o", 0.9, 1, None)]
    spark.createDataFrame(task, "id string, prompt string, fail_to_pass array<string>, pass_to_pass array<string>, patch string, meta map<string,string>, language string, repo string, quality_score double, difficulty_score int, workspace_path string").write.parquet(str(tmp_path / "k"))
    assert say("validate", tmp_path / "k", tmp_path / "f") == {"status": "success", "outcomes": {"passed": 1}}
    assert say("generate", tmp_path / "k", tmp_path / "g", "--category", "rust") == {"status": "success", "tasks": 1}
    assert say("generate", tmp_path / "k", tmp_path / "g2", "--category", "cobol") == {"status": "success", "tasks": 0}
