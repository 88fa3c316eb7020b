import pytest

from millrace.llm import residue, spam

OWN = "After the upgrade the worker returned a stale lease instead of an error."
POSITIVE = [
    "Your title here", "[TICKET-000] replace me", "fix: ${change}", "Add <feature> to <module>", "HTTP 429", "404 Service Unavailable",
    OWN + "\n\nJira: __TICKET_ID__", "## Summary\n{{ summary }}\n\n## Testing\n{{ test_plan }}\n", "### What\n<!-- Describe your change here -->\n",
    "Please enable JavaScript to view this page.", "Bitte aktivieren Sie JavaScript, um fortzufahren.", "La page demandée est introuvable.",
    "Lorem ipsum dolor sit amet consectetur adipiscing elit", "blah blah blah", "Wait 309 seconds and reload.", "Access denied | somewhere",
    "<html><head><title>404 Error</title></head><body><h1>404</h1></body></html>", "TODO: write a description\n\nSee also #ISSUE_NUMBER",
]
NEGATIVE = [
    "", None, "Untitled change", "Return 404 Not Found for a missing config", "Access denied: log the symbol instead",
    'The login screen showed "Please enable JavaScript" even with scripts on.', "Replaced the lorem ipsum in the demo fixture by proper wording.",
    "Render `{{ epoch }}` in the mail template without escaping it twice.", "Allow <T> in shard signatures", "Format strings such as %s are checked.",
    "Reject forms that still contain the text [INSERT LINK] or TODO.", "## Summary\n" + OWN + "\n\n## Testing\n- [x] tests added", "Enable JavaScript source maps for budget",
]


def test_residue(spark):
    rows = [(i, t, "x") for i, t in enumerate(POSITIVE + NEGATIVE)] + [(1000 + i, f"{OWN} {i}", "x") for i in range(300)]
    df = spark.createDataFrame(rows, "row_id bigint, body string, exemplar string")
    got = {r["row_key"] for r in residue.residue(df, fields=("body",)).collect()}
    assert got == set(range(len(POSITIVE)))
    assert residue.without_residue(df, fields=("body",)).count() == len(rows) - len(POSITIVE)
    assert residue.residue(df.limit(0), fields=("body",)).count() == 0


def test_scope_is_no_content_and_unseen_words_weigh_what_they_are(spark):
    texts = ["[braosta] ${change}", "feat(api): <%= title %>", "core: <insert title>", "Enable JavaScript to continue, please", "Enable JavaScript source maps in gulp"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, f"please {OWN} {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "row_id bigint, title string")
    assert {r["row_key"] for r in residue.residue(df, fields=("title",)).collect()} == {0, 1, 2, 3}
    own = spark.createDataFrame([("Seite im Aufbau", "failure"), (None, None)], "text string, label string")
    df = spark.createDataFrame([(1, "Seite im Aufbau"), (2, OWN), (None, "Seite im Aufbau")], "row_id bigint, title string")
    assert [r["row_key"] for r in residue.residue(df, fields=("title",), exemplars=own).collect() if r["row_key"]] == [1]
    assert residue.exemplar_table(spark).groupBy("label").count().count() == 4


def test_verdicts_do_not_depend_on_the_number_of_rows():
    lines = ["Sitzung abgelaufen Konto", "alpha beta gamma delta epsilon zeta eta theta"]
    asked = [["sitzung", "abgelaufen", "eins", "zwei"], ["alpha", "beta", "gamma", "delta"], ["sitzung", "konto"], ["alpha", "beta", "eins"]]
    tables = [residue.Index(lines, {"alpha": n // 10, "konto": n // 4, "eins": n // 50}, n) for n in (120, 12_000, 1_200_000, 120_000_000)]
    assert len({tuple(t.hit(w) for w in asked) for t in tables}) == 1
    assert all(t.weight == pytest.approx(tables[0].weight) for t in tables)


PROSE = "When two workers match the same secret, the second one waits for at most a few seconds and the queue is left alone."
PAGES = {
    1: ("buy cheap git runner | " * 40, True),
    2: ("\n".join(f"DEN-{i}A stale / ledger / buy" for i in range(60)), True),
    3: ("\n".join(f"- [cheap theme {i % 3}](https://x.test/{i})" for i in range(40)), True),
    4: ("\n".join(f'<a href="//x.invalid/{i}">instant api bounty</a>' for i in range(40)), True),
    5: ("fast repo key\nheader review\n" * 40, True),
    6: ("Tags: " + ", ".join(f"{w} download" for w in "a1 b2 c3 d4 e5".split() * 12), True),
    7: ("\n".join(f"- [tool{i}](https://x.example/{i}) - {PROSE}" for i in range(20)), False),
    8: ("\n".join([PROSE] * 20), False),
    9: ("```\n" + "call(a); call(b);\n" * 60 + "```\n" + PROSE, False),
    10: (PROSE + " https://x.example/a", False),
    11: ("", False),
    12: (None, False),
    13: (PROSE + "\n" + "cheap git runner, " * 60, True),
}


def test_pages(spark):
    rows = [(k, t, "en", 1) for k, (t, _) in PAGES.items()] + [(100 + i, PROSE, None if i % 2 else "en-GB", 1) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, words int")
    got = {r["doc_id"] for r in spam.keyword_pages(df).where("spam").collect()}
    assert got == {k for k, (_, bad) in PAGES.items() if bad}
    assert spam.keyword_pages(df.limit(0)).count() == 0


POLISH = "Kiedy dwa procesy chcą tego samego klucza, drugi z nich czeka na pierwszy, ale nie dłużej niż kilka sekund, i na tym się to kończy."
ITALIAN = "Quando due processi chiedono la stessa chiave, il secondo aspetta che il primo la lasci, ma non più di qualche secondo, e poi va avanti."
CHINESE = "当两个进程同时请求同一个键时，第二个进程会等待第一个进程，但不会超过几秒钟，然后继续执行。"


def test_unlisted_languages(spark):
    rnd = __import__("random").Random(2)
    mixed = lambda t: " ".join(rnd.sample(t.split(), len(t.split())))
    rows = [(i, mixed(POLISH) + ".", "pl") for i in range(40)] + [(100, "\n".join([POLISH] * 2), "pl"), (101, "tani serwer, " * 60, "pl")]
    rows += [(200, ITALIAN, "it"), (201, "codice sconto | " * 60, "it"), (202, "\n".join(f"- [offerta {i}](https://x.test/{i})" for i in range(30)), "it")]
    rows += [(300, CHINESE, "zh"), (301, "便宜 服务器, " * 60, "zh")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    words = spam.learned_words(df)
    assert {"na", "nie", "się"} <= words["pl"] and "it" not in words
    got = {r["doc_id"] for r in spam.keyword_pages(df).where("spam").collect()}
    assert got == {101, 201, 202, 301}


def test_long_constructs_are_read_whole(spark):
    label = "cheap runner " * 100  # link texts and tags of more than a thousand characters
    rows = [(1, "\n".join(f"[{label}](https://x.test/{i})" for i in range(5)), "en"), (2, f'<a href="//x" title="{label}">{PROSE}</a>', "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {r["doc_id"] for r in spam.keyword_pages(df).where("spam").collect()} == {1}


@pytest.mark.parametrize("code, want", [("en-GB", "en"), (" DE", "de"), ("", "und"), (None, "und"), ("x", "und")])
def test_language(spark, code, want):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(code,)], "c string").select(spam.language(F.col("c"))).first()[0] == want
