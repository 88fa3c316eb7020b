import uuid

import pytest
from pyspark.sql import functions as F

from millrace.functions import integrity, jsonx, paths, text
from millrace.operators.selection import parse_list, parse_quotas


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "path, want",
    [("tests/test_a.py", True), ("pkg/a_test.go", True), ("src/app.spec.ts", True), ("a/__tests__/x.js", True), ("x/conftest.py", True),
     ("src/main.py", False), ("docs/testing.md", False), ("tests/a.py", False)],
)
def test_is_test(spark, path, want):
    assert one(spark, path, paths.is_test) is want


def test_lists_need_files(spark):
    df = spark.createDataFrame([([],), (["README"],), (["a.md", "b.rs"],)], "p array<string>")
    got = [r[0] for r in df.select(paths.all_of(F.col("p"), paths.is_doc)).collect()]
    assert got == [False, True, False]


@pytest.mark.parametrize("ref, ok", [("main", True), ("-rf", False), ("a..b", False), ("v1~2^", True), ("x" * 257, False), ("a b", False)])
def test_refs(spark, ref, ok):
    assert one(spark, ref, paths.valid_ref) is ok


@pytest.mark.parametrize("p, ok", [("src/a.py", True), ("/etc/passwd", False), ("a/../b", False), ("a;rm", False), ("", False)])
def test_paths(spark, p, ok):
    assert one(spark, p, paths.valid_path) is ok


def test_issue_links_first_of_each_in_order(spark):
    assert one(spark, "Resolves #9, closes #2 and #3, FIXES #7 fixes #8", text.issue_links) == [7, 2, 9]
    assert one(spark, None, text.issue_links) == []
    assert one(spark, "fixes #" + "9" * 40, text.issue_links) == []


DIFF = (
    "junk\ndiff --git a/src/x.py b/src/x.py\n--- a/src/x.py\n+++ b/src/x.py\n@@\n+one\n-two\n"
    "diff --git a/pkg/x_test.py b/pkg/x_test.py\n@@\n+three"
)


def test_split_diff(spark):
    s = one(spark, DIFF, text.split_diff)
    assert s["solution"].startswith("diff --git a/src/x.py") and s["solution"].endswith("\n")
    assert s["tests"].startswith("diff --git a/pkg/x_test.py")
    assert one(spark, "no header", text.split_diff)["solution"] == "no header"
    assert one(spark, None, text.split_diff) is None


def test_line_delta(spark):
    assert tuple(one(spark, DIFF, text.line_delta)) == (2, 1)


@pytest.mark.parametrize("s, n", [("abc", 5), ("äöü", 3), ("äöü", 4), ("a€b", 2), ("a€b", 4), ("x😀y", 3), ("x😀y", 5), ("", 2)])
def test_truncate(spark, s, n):
    cut = one(spark, s, lambda c: text.truncate_bytes(c, n))
    assert cut == s.encode()[:n].decode(errors="ignore")


def test_commands(spark):
    got = one(spark, "python -m unittest pkg.mod 'tests/a.py'; *.py", text.command_paths)
    assert got == ["tests/a.py", "pkg/mod.py", "*/py.py"]


def test_strip_identifiers(spark):
    df = spark.createDataFrame([("See o/r and #12, pull/12  now", "o/r", 12)], "t string, r string, n bigint")
    assert df.select(text.strip_identifiers(F.col("t"), F.col("r"), F.col("n"))).first()[0] == "See and ,  now"


def test_canary_is_a_v5_uuid(spark):
    seed = (42).to_bytes(8, "little").hex()
    want = "CANARY-" + str(uuid.uuid5(uuid.NAMESPACE_OID, f"task-{seed}")).upper()
    assert one(spark, "task", lambda c: integrity.canary_id(c, 42)) == want


def test_contamination(spark):
    cid = one(spark, "task", lambda c: integrity.canary_id(c, 1))
    check = lambda out: one(spark, out, lambda c: integrity.contamination(c, F.lit(cid)))
    assert tuple(check("x " + cid.lower())) == (True, True, True, 1.0)
    assert check("clean")["confidence"] == 0.0
    assert check("part " + cid[7:15])["confidence"] == 0.6


@pytest.mark.parametrize("t", ["plain", "ünï €", "", "x" * 300])
def test_seal(spark, t):
    assert one(spark, t, lambda c: integrity.unseal(integrity.seal(c, "kéy"), "kéy")) == t
    with pytest.raises(ValueError):
        integrity.seal(F.col("v"), "")


@pytest.mark.parametrize(
    "answer, want",
    [
        ('{"k": "v"}', ("success", '{"k": "v"}', 0, 0)),
        ('Here:\n```json\n{"k": 1}\n```\nbye', ("success", '{"k": 1}', 0, 0)),
        ('```\nlet x = {"k": 1}\n```', ("success", '{"k": 1}', 0, 0)),
        ('ok {"a": 1} then {"b": {"c": 2}} end', ("success", '{"b": {"c": 2}}', 0, 0)),
        ('list: [1, 2, 3] done', ("success", "[1, 2, 3]", 0, 0)),
        ('{"m": "He said \\"hi\\" {"}', ("success", '{"m": "He said \\"hi\\" {"}', 0, 0)),
        ('{"a": {"b": 1', ("truncated", '{"a": {"b": 1', 2, 0)),
        ('{"a": [1, 2', ("truncated", '{"a": [1, 2', 1, 1)),
        ("[1, 2", ("truncated", "[1, 2", 0, 1)),
        ("nothing", ("not_found", None, 0, 0)),
        ("", ("not_found", None, 0, 0)),
        (None, ("not_found", None, 0, 0)),
    ],
)
def test_json(answer, want):
    assert jsonx.extract(answer) == want


def test_quota_text():
    assert parse_quotas(" easy:2, HARD : 3,easy:5") == {"easy": 5, "hard": 3}
    for bad in ("", "easy", "odd:1", "easy:x"):
        with pytest.raises(ValueError):
            parse_quotas(bad)
    assert parse_list(" Go, ,rust ") == ["go", "rust"]
