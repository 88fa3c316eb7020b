import random

import pytest

from millrace.llm import source_files as sf

RND = random.Random(5)
B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
NOUNS = "ledger packet worker signal folder budget cursor stream handler router".split()


def name():
    return "_".join(RND.choice(NOUNS) for _ in range(2))


def block(path, lines):
    return f"diff --git a/{path} b/{path}\nindex 1..2\n--- a/{path}\n+++ b/{path}\n@@ -0,0 +1,9 @@\n" + "\n".join("+" + x for x in lines)


CODE = lambda n=14: [f"    {name()} = {name()}({name()}, {RND.randint(1, 99)})" for _ in range(n)]
MINIFIED = lambda: ";".join(f"{RND.choice('abcdefghjkq')}={RND.choice('uvwxyz')}[{RND.choice('mnop')}]({RND.choice('abcd')})" for _ in range(30))
MIN = ['!function(a,u){var c=q.lockset(13),q=c[7];if(j>4)r.build("x");else d.y=function(u){return u.e&&u(0xef3)};}(e,v)']
FILES = {
    "src/app/own.py": (CODE(), None),
    "core/vendor_portal/own.py": (CODE(), None),
    "src/app/gen.py": (["# Code generated by toolc 1.2. DO NOT EDIT.", *CODE()], "generated"),
    "src/app/note.py": ([*CODE(3), "# ids are generated by the caller", *CODE()], None),
    "src/ext/lib.py": (["# Vendored copy of lib 1.2.3; upstream sources live elsewhere.", *CODE()], "vendored"),
    "src/app/licensed.py": (["# Copyright the app authors, see LICENSE.", *CODE()], None),
    "web/page.js": (MIN, "minified"),
    "src/app/blob.py": (['X = "' + "".join(RND.choice(B64) for _ in range(900)) + '"'], "data"),
    "src/app/nums.py": (["t = ["] + ["  " + ", ".join(f"0x{RND.randint(0, 255):02x}" for _ in range(12)) for _ in range(20)], "data"),
    "vendor/x/y.go": (CODE(), "vendored"),
    "api/x.pb.go": (CODE(), "generated"),
    "yarn.lock": (["a v1"], "lock"),
    "dist/x.min.js": (["short"], "minified"),
    "docs/generated/readme.md": (["Code generated by hand. DO NOT EDIT."], None),
    "tests/test_x.py": (CODE(), None),
}


def test_judged_files(spark):
    patch = "\n".join(block(p, ls) for p, (ls, _) in FILES.items())
    more = "\n".join(block(f"src/m{i}.py", CODE(30)) for i in range(30))
    patches = spark.createDataFrame(
        [(" A/b", 1, patch, None, "k"), ("a/b", 2, more, "", "k"), ("x/y", None, None, "no diff", "k")], "repo string, pr_number bigint, patch string, test_patch string, kind string"
    )
    enriched = spark.createDataFrame(
        [("a/B ", 1, [*FILES, None, ""]), ("a/B ", 1, [*FILES]), ("q/r", 9, ["node_modules/a.js", "a.js"]), ("n/n", 3, None), ("n/n", 4, [])],
        "repository string, number bigint, changed_files array<string>",
    )
    got = {(r["repository"], r["pull_number"], r["file_path"]): r["kind"] for r in sf.judged_files(enriched, patches).collect()}
    want = {("a/b", 1, p): k for p, (_, k) in FILES.items()} | {("q/r", 9, "node_modules/a.js"): "vendored", ("q/r", 9, "a.js"): None}
    assert got == want
    assert sf.hand_written(enriched, patches).count() == sum(v is None for v in want.values())
    assert sf.judged_files(enriched.limit(0), patches.limit(0)).count() == 0


def test_the_models_decide(spark):
    """Ablation: with emptied models the files that only their names give away count as hand-written."""
    odd = {
        "src/a/mangled.py": [MINIFIED()],
        "src/a/blob.py": ['X = "' + "".join(RND.choice(B64) for _ in range(900)) + '"'],
        "src/a/table.py": ["t = ["] + ["  " + ", ".join(str(RND.randint(0, 999)) for _ in range(12)) for _ in range(20)],
        "src/a/digests.py": [f"h{i} = '{RND.randbytes(16).hex()}'" for i in range(20)],
    }
    rows = [("r/r", i, "\n".join(block(f"src/m{i}_{j}.py", CODE(30)) for j in range(5))) for i in range(60)]
    rows.append(("r/r", 99, "\n".join(block(p, ls) for p, ls in odd.items())))
    patches = spark.createDataFrame([(*r, None) for r in rows], "repo string, pr_number bigint, patch string, test_patch string")
    files = [("r/r", i, [f"src/m{i}_{j}.py" for j in range(5)]) for i in range(60)] + [("r/r", 99, list(odd))]
    enriched = spark.createDataFrame(files, "repository string, number bigint, changed_files array<string>")
    found = {r["file_path"]: r["by"] for r in sf.judged_files(enriched, patches).where("kind is not null").collect()}
    assert found == dict.fromkeys(odd, "names")
    empty = sf.Names({lang: sf.np.zeros(sf.A**3) for lang in sf.CODES})
    left = {r["file_path"] for r in sf.judged_files(enriched, patches, empty).where("kind is not null").collect()}
    assert "src/a/blob.py" not in left and "src/a/digests.py" not in left


def test_foreign_style_and_diversity():
    rnd = random.Random(3)
    snake = "\n".join(f"def load_{rnd.choice(NOUNS)}(self, {rnd.choice(NOUNS)}_id):" for _ in range(400))
    camel = "\n".join(f"export function load{rnd.choice(NOUNS).title()}({rnd.choice(NOUNS)}Id: string) {{" for _ in range(400))
    counts = {k: sf.np.bincount(sf.trigrams(sf._codes(v)), minlength=sf.A**3) for k, v in {"python": snake, "typescript": camel}.items()}
    model = sf.Names(counts)
    one, two = snake[:900], camel[:900]
    assert model.measure("python", one, sf._codes(one))[1] < 0.01
    assert model.measure("typescript", one, sf._codes(one))[1] > sf.FOREIGN
    assert model.measure("python", two, sf._codes(two))[1] > sf.FOREIGN
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    assert sf.diversity(" ".join(words)) == 1.0
    assert sf.diversity(" ".join(str(i) for i in range(300))) == pytest.approx(1 / sf.SPAN)
    text = [rnd.choice(words[:40]) for _ in range(200)]
    brute = [len(set(text[i : i + sf.SPAN])) / sf.SPAN for i in range(len(text) - sf.SPAN + 1)]
    assert sf.diversity(" ".join(text)) == pytest.approx(sum(brute) / len(brute))


LICENCE = [f"Licence line {i}, all rights reserved." for i in range(20)]
MARK = "Code generated by toolc 2. DO NOT EDIT."


@pytest.mark.parametrize(
    "lines, want",
    [
        ([*(f"+// {x}" for x in LICENCE), f"+// {MARK}", "+package x"], "generated"),
        (["+/*", *(f"+   {x}" for x in LICENCE), f"+   {MARK}", "+*/", "+package x"], "generated"),
        (["+/*", *(f"+   {x}" for x in LICENCE), "+*/", "+", f"+// {MARK}"], "generated"),
        (["-// Code generated by toolc 1. DO NOT EDIT.", f"+// {MARK}", " package x"], "generated"),
        (["-import a", "-import b", "+# Vendored copy of lib 1.2.3.", "+import c"], "vendored"),
        (["-// Code generated by toolc 1. DO NOT EDIT.", "+package x"], None),
        (["+/* ours */ package x", f"+// {MARK}"], None),
        (["+/* ours", "+*/", "+package x", f"+// {MARK}"], None),
        (["@@ -1,3 +1,3 @@", "+/*", "+ ours", "@@ -40,3 +40,3 @@", f'+x = "{MARK}"'], None),
        (["@@ -1,3 +1,3 @@", "+/*", "+ ours", "@@ -40,3 +40,3 @@", f"+ {MARK}", " */", " x"], "generated"),
    ],
)
def test_notice_reads_all_first_comments(lines, want):
    assert sf.notice(lines) == want
