"""NULLs in every column, repeated rows, empty tables and columns whose names clash, for every operator."""

import pytest
from pyspark.sql import functions as F

from millrace.llm import cap, mix, neardup, pack, pii, residue, sample, source_files, spam

TEXT = "When two workers match the same secret, the second one waits for the first and the queue is left alone."
CLASH = ("row", "cell", "cat_difficulty", "draw", "side", "size", "n", "q", "p", "term", "lang_", "rank_id", "slice", "box", "pid", "verdict", "words")


def wide(df):
    """Columns named like those the operators use themselves, rows twice, and a row of NULLs."""
    bare = df.unionByName(df)
    nothing = bare.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in bare.schema.fields])
    return bare.unionByName(nothing).select("*", *[F.lit("x").alias(c) for c in CLASH if c not in df.columns])


def empty(df):
    return df.limit(0)


ROWS = "row_id bigint, repo string, pr_number bigint, title string, body string, patch string, test_patch string, quality_score double"


def changes(spark):
    patch = "diff --git a/src/a.py b/src/a.py\n@@ -0,0 +1,2 @@\n+def load_packet(handler):\n+    return handler\n"
    return spark.createDataFrame([(i, "a/b", i, "t", TEXT, patch, None, 0.5) for i in range(6)], ROWS)


def documents(spark):
    return spark.createDataFrame([(i, TEXT, "en", "s") for i in range(6)], "doc_id bigint, text string, lang string, source string")


def run(spark, shape):
    pr, docs = shape(changes(spark)), shape(documents(spark))
    parts = shape(spark.createDataFrame([("Ann", "given")], "name_part string, part_kind string"))
    texts = pr.select("*", F.lit("t").alias("tbl"), F.col("row_id").cast("string").alias("rec_key"), F.col("body").alias("text"))
    files = shape(spark.createDataFrame([("a/b", 1, ["src/a.py", None])], "repository string, number bigint, changed_files array<string>"))
    data = shape(spark.createDataFrame([(str(i), "easy", "go") for i in range(9)], "instance_id string, difficulty string, language string"))
    aims = spark.createDataFrame([(1, "difficulty", "easy", 1.0, 1), (2, "language", "go", 1.0, 1)], "target_id int, dim string, category string, target_share double, min_rows int")
    sources = shape(spark.createDataFrame([("s", 1.0, 2)], "source string, weight double, max_repeats int"))
    profiles = shape(spark.createDataFrame([("p", 30)], "profile string, capacity_tokens int"))
    links = neardup.near_duplicates(pr)
    return {
        "pii": pii.find_pii(texts, parts).count(),
        "sanitized": pii.sanitize(texts, parts).count(),
        "residue": residue.residue(pr).count(),
        "kept": residue.without_residue(pr).count(),
        "files": source_files.judged_files(files, pr).count(),
        "over": cap.over_cap(pr, max_rows=4).count(),
        "capped": cap.cap_per_contributor(pr, max_rows=4).count(),
        "pairs": neardup.similar_pairs(links).count(),
        "classes": neardup.class_links(links).count(),
        "sample": sample.sample(data, aims).count(),
        "report": sample.report(data, aims).count(),
        "packed": pack.pack(docs, profiles).count(),
        "fill": pack.fill_report(docs, profiles).count(),
        "mixture": mix.mixture(docs, sources).count(),
        "shares": mix.mix_report(docs, sources).count(),
        "pages": spam.keyword_pages(docs).count(),
    }


def test_nulls_repeats_and_clashes(spark):
    got = run(spark, wide)
    assert got["sanitized"] == 13 and got["kept"] == 13 and got["pages"] == 13
    assert got["pairs"] == 15 and got["classes"] == 12
    assert got["capped"] + got["over"] == 13 and got["over"] == 8
    assert got["files"] == 1 and got["report"] == 2 and got["fill"] == 1 and got["shares"] == 1
    assert got["packed"] == 12 and got["mixture"] >= 12


def test_empty_tables(spark):
    got = run(spark, empty)
    assert got.pop("report") == 2
    assert set(got.values()) == {0}


@pytest.mark.parametrize("text", ["", " ", "\n" * 5000, "a" * 200_000, ("word " * 40_000) + "end.", "é" * 30_000, "{{" * 20_000, "[" * 20_000, "<a " * 20_000, '"' * 20_001, "1 " * 20_000, "Ab " * 5_000])
def test_very_long_texts(spark, text):
    known = pii.Known([("Ann", "given")])
    pii.proposals(text, known)
    spam.features(text)
    index = residue.Index(residue.EXEMPLARS, {"a": 1}, 10)
    [index.look(w) for w in residue.windows(text)]
    neardup.shingle_sets([text])
    source_files.diversity(text)
