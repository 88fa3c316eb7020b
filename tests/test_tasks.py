from pyspark.sql import functions as F

from millrace.operators import tasks


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_feasibility_first_reason(spark):
    long = "Explain in detail what the worker does when the queue is empty and nobody answers its request for another item. "
    data = [(" ", ["x"], ["a/t.py"]), ("too short", ["x"], ["a/t.py"]), (long + "Run PYTEST -q now", ["pytest -q"], []),
            (long + "see T.py", ["zz"], ["a/t.py"]), (long, ["zz"], ["a/q.py"]), (None, [], []), (long, [" "], [""])]
    df = spark.createDataFrame(data, "p string, c array<string>, f array<string>")
    got = [r[0] for r in df.select(tasks.feasibility(F.col("p"), F.col("c"), F.col("f"))).collect()]
    assert got == ["empty", "short", "names a command", "names a file", None, "empty", None]


def test_created_and_unknown_files(spark):
    out = spark.createDataFrame([("t", "a/x.py"), ("t", ".hidden"), ("t", "in.txt"), ("t", "a/x.py")], "task_id string, path string")
    given = spark.createDataFrame([("t", "in.txt")], "task_id string, path string")
    assert rows(tasks.created_files(out, given)) == [("t", "a/x.py")]
    cmds = spark.createDataFrame([("t", "pytest deep/x.py gone.py")], "task_id string, command string")
    assert rows(tasks.unknown_references(cmds, out)) == [("t", "gone.py")]


def test_best_offer(spark):
    req = spark.createDataFrame([(1, 10), (2, 500), (3, 9000), (4, 200)], "request_id int, need int")
    offers = spark.createDataFrame([("s", 200, 5), ("m", 800, 1), ("h", 4000, 9)], "name string, room int, cost int")
    assert rows(tasks.best_offer(req, offers, "need", "room", ["cost"])) == [(1, "m"), (2, "m"), (3, None), (4, "m")]
    assert rows(tasks.best_offer(req.limit(0), offers, "need", "room", ["cost"])) == []
    assert {r[1] for r in rows(tasks.best_offer(req, offers.limit(0), "need", "room", ["cost"]))} == {None}


def test_submission(spark):
    a = spark.createDataFrame([("t", i, bad, soft) for i, (bad, soft) in enumerate([(True, False), (False, True), (True, False), (False, True), (False, False)])],
                              "task_id string, attempt int, bad boolean, soft boolean")
    got = rows(tasks.submission(a, [("bad", F.col("bad"), True), ("soft", F.col("soft"), False)], retries=2))
    assert [r[2] for r in got] == ["retry", "retry", "refused", "accepted", "accepted"]
    assert [r[3] for r in got] == ["bad", "soft", "bad", None, None]


def test_small_columns(spark):
    df = spark.createDataFrame([("a/b c", "it's", "sk-1234567890", "short", None)], "n string, q string, k string, s string, z string")
    r = df.select(tasks.safe_name(F.col("n")), tasks.shell_quote(F.col("q")), tasks.mask(F.col("k")), tasks.mask(F.col("s")),
                  tasks.provenance(a=F.col("n"), z=F.col("z")), tasks.select_message(F.col("z"), F.col("s"))).first()
    assert tuple(r) == ("a-b_c", "'it'\\''s'", "sk-1...7890", "*****", {"a": "a/b c"}, "short")
    s = spark.createDataFrame([(3600.0, 0.0, 5.0), (0.0, 2.0, 0.0)], "t double, s double, h double")
    assert [x[0] for x in s.select(tasks.difficulty_score(F.col("t"), F.col("s"), F.col("h"))).collect()] == [1.0, 0.0]
