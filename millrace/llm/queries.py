"""The queries of the training-data problems and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import cap, mix, neardup, pack, pii, residue, sample, source_files, spam
from millrace.runtime import fold, materialize, table

CAP_SHARE = Fraction(1, 50)


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """The texts of problem 2 in one table."""
    cached = table(spark, d, "pr_cache").select(
        F.lit("pr_cache").alias("tbl"), F.col("row_id").cast("string").alias("rec_key"), F.col("body").alias("text")
    )
    tasks = table(spark, d, "swe_tasks").select(
        F.lit("swe_tasks").alias("tbl"), F.col("id").alias("rec_key"), F.col("original_pr_body").alias("text")
    )
    return cached.unionByName(tasks)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    found = pii.find_pii(_texts(spark, d), table(spark, d, "name_parts"))
    return found.select("tbl", "rec_key", "pii_kind", "pii_text").distinct()


def p2_sanitized(spark: SparkSession, d: str) -> DataFrame:
    return pii.sanitize(_texts(spark, d), table(spark, d, "name_parts"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "pr_cache")).select(F.col("row_key").alias("row_id")).distinct()


def p3_kept(spark: SparkSession, d: str) -> DataFrame:
    return residue.without_residue(table(spark, d, "pr_cache")).select("row_id", "title", "body")


def _entries(spark: SparkSession, d: str) -> DataFrame:
    return source_files.judged_files(table(spark, d, "enriched_prs"), table(spark, d, "pr_cache"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).where("kind is not null").drop("kind", "by")


def p4_hand_written(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).where("kind is null").drop("kind", "by")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return cap.over_cap(table(spark, d, "pr_cache"), share=CAP_SHARE).select(F.col("rank_id").alias("row_id"))


def p5_kept(spark: SparkSession, d: str) -> DataFrame:
    kept = cap.cap_per_contributor(table(spark, d, "pr_cache"), share=CAP_SHARE)
    return kept.select("row_id", "repo", "pr_number")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.similar_pairs(neardup.near_duplicates(table(spark, d, "pr_cache")))


def p6_classes(spark: SparkSession, d: str) -> DataFrame:
    return neardup.class_links(neardup.near_duplicates(table(spark, d, "pr_cache")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    report = sample.report(table(spark, d, "dataset_rows"), table(spark, d, "sample_targets"))
    return report.where("unmet").select("target_id")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return sample.report(table(spark, d, "dataset_rows"), table(spark, d, "sample_targets"))


def p7_sample(spark: SparkSession, d: str) -> DataFrame:
    drawn = sample.sample(table(spark, d, "dataset_rows"), table(spark, d, "sample_targets"))
    return drawn.select("instance_id", "difficulty", "language")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    packed = pack.pack(table(spark, d, "documents"), table(spark, d, "packing_profiles"))
    return packed.where("n_pieces > 1").select("profile", "doc_id").distinct()


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return pack.pack(table(spark, d, "documents"), table(spark, d, "packing_profiles"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return pack.fill_report(table(spark, d, "documents"), table(spark, d, "packing_profiles"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    report = mix.mix_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))
    return report.where("short").select("source")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    made = mix.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))
    return made.select("position", "source", "doc_id", "copy", "tokens")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix.mix_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.keyword_pages(table(spark, d, "documents")).where("spam").select("doc_id").distinct()


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return spam.keyword_pages(table(spark, d, "documents"))


# Queries over the operators' results that SQL can state, where it cannot state the result itself.
def p2_rows(spark: SparkSession, d: str) -> DataFrame:
    """Sanitising neither loses nor adds a text, and leaves NULL and empty ones as they are."""
    clean = pii.sanitize(_texts(spark, d), table(spark, d, "name_parts"))
    return clean.groupBy("tbl").agg(
        F.count("*").alias("texts"), F.count_if(F.col("text").isNull()).alias("missing"), F.count_if(F.col("text") == "").alias("empty")
    )


def p3_split(spark: SparkSession, d: str) -> DataFrame:
    """Rows with residue and the rest are all rows."""
    rows = table(spark, d, "pr_cache")
    gone = residue.residue(rows).select("row_key").distinct().agg(F.count("*").alias("gone"))
    kept = residue.without_residue(rows).agg(F.count("*").alias("kept"))
    return kept.join(gone, F.lit(True)).select((F.col("kept") + F.col("gone")).alias("total"))


def p4_split(spark: SparkSession, d: str) -> DataFrame:
    """Every entry gets one verdict."""
    return _entries(spark, d).agg(F.count("*").alias("entries"), F.count_distinct("repository", "pull_number", "file_path").alias("different"))


def p6_copies(spark: SparkSession, d: str) -> DataFrame:
    """Texts that are equal byte by byte, from the classes of the operator."""
    m = neardup.near_duplicates(table(spark, d, "pr_cache")).members
    return m.where("same > 1").select("side", "row_id", "text_id", "same")


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """What is drawn is what the report says, within what there is, and no less than is needed where that is possible."""
    rows, targets = table(spark, d, "dataset_rows"), table(spark, d, "sample_targets")
    told = sample.report(rows, targets)
    drawn = sample.sample(rows, targets)
    got = reduce(
        DataFrame.unionByName,
        [drawn.groupBy(fold(c).alias("category")).agg(F.count("*").alias("n")).select(F.lit(c).alias("dim"), "category", "n") for c in ("difficulty", "language")],
    )
    n = F.coalesce("n", F.lit(0))
    return told.join(got, ["dim", "category"], "left").select(
        "target_id", "available", F.round("needed", 6).alias("needed"), "unmet", (n == F.col("sampled")).alias("as_reported"), (n <= F.col("available")).alias("within")
    )


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per profile: every token is packed once, in as few pieces as can be, and no container is over its capacity."""
    packed = materialize(pack.pack(table(spark, d, "documents"), table(spark, d, "packing_profiles")), "checked")
    caps = table(spark, d, "packing_profiles").groupBy("profile").agg(F.max("capacity_tokens").alias("capacity"))
    full = packed.groupBy("profile", "container").agg(F.sum("tokens").alias("held")).join(caps, "profile").groupBy("profile").agg(
        F.count_if(F.col("held") > F.col("capacity")).alias("over"), (F.count("*") >= F.ceil(F.sum("held") / F.max("capacity"))).alias("bounded")
    )
    whole = packed.groupBy("profile").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"))
    return whole.join(full, "profile").select("profile", "tokens", "pieces", "over", "bounded")


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per source: a short one is served whole as often as it may, none more often, and the budget is not exceeded."""
    told = mix.mix_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))
    whole = Window.partitionBy(F.lit(1))  # a row per target
    return told.select(
        "source", "tokens", F.when(F.col("short"), F.col("mixed_tokens")).alias("served_if_short"),
        (F.col("rounds") <= F.col("max_repeats")).alias("as_often"), (F.sum("share_of_budget").over(whole) <= 1 + 1e-9).alias("within"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p2_found, p2_sanitized, p3_found, p3_kept, p4_found, p4_hand_written, p5_found, p5_kept, p6_found, p6_classes,
        p7_found, p7_report, p7_sample, p8_found, p8_packed, p8_fill, p9_found, p9_mixture, p9_shares, p10_found, p10_scores,
        p2_rows, p3_split, p4_split, p6_copies, p7_checks, p8_checks, p9_checks,
    )
}

_RANKED = r"""
    SELECT row_id, repo, pr_number,
           row_number() OVER (
               PARTITION BY coalesce(lower(regexp_replace(repo, '^\s+|\s+$', '', 'g')), '')
               ORDER BY CASE WHEN quality_score IS NULL OR isnan(quality_score) THEN 1.0
                             ELSE -least(greatest(quality_score, 0.0), 1.0) END,
                        coalesce(pr_number, 4611686018427387903), row_id) AS rn,
           count(*) OVER () AS n
    FROM pr_cache
"""
_NEEDS = r"""
    SELECT t.target_id, t.dim, lower(trim(t.category)) AS category,
           greatest(CAST(t.min_rows AS DOUBLE), t.target_share * (CAST(0.3 AS DOUBLE) * (SELECT count(*) FROM dataset_rows))) AS needed,
           CASE t.dim
               WHEN 'difficulty' THEN (SELECT count(*) FROM dataset_rows d WHERE lower(trim(d.difficulty)) = lower(trim(t.category)))
               ELSE (SELECT count(*) FROM dataset_rows d WHERE lower(trim(d.language)) = lower(trim(t.category)))
           END AS available
    FROM sample_targets t
"""
_TOKENS = r"len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]+'))"

_WORDS = "regexp_extract_all(lower({c}), '[a-z0-9_]+')"
_SHINGLES = """
    SELECT DISTINCT row_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
    FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT row_id, {w} AS w FROM pr_cache WHERE {c} IS NOT NULL))
"""


def _similar(c: str) -> str:
    sets = _SHINGLES.format(w=_WORDS.format(c=c), c=c)
    return f"""
        SELECT a AS row_id_a, b AS row_id_b FROM (
            WITH s AS MATERIALIZED ({sets}), n AS (SELECT row_id, count(*) AS n FROM s GROUP BY row_id),
                 m AS (SELECT p.row_id AS a, q.row_id AS b, count(*) AS shared FROM s p JOIN s q ON p.s = q.s AND p.row_id < q.row_id GROUP BY ALL)
            SELECT a, b FROM m JOIN n p ON p.row_id = m.a JOIN n q ON q.row_id = m.b WHERE shared >= 0.6 * (p.n + q.n - shared) - 1e-9)
    """


_SIZED = f"SELECT source, {_TOKENS} AS tokens FROM documents"
SQL: dict[str, str] = {
    "p2_rows": """
        SELECT tbl, count(*) AS texts, count(*) FILTER (t IS NULL) AS missing, count(*) FILTER (t = '') AS empty
        FROM (SELECT 'pr_cache' AS tbl, body AS t FROM pr_cache UNION ALL SELECT 'swe_tasks', original_pr_body FROM swe_tasks) GROUP BY tbl
    """,
    "p3_split": "SELECT count(*) AS total FROM pr_cache",
    "p4_split": """
        SELECT count(*) AS entries, count(*) AS different
        FROM (SELECT DISTINCT lower(trim(repository)), number, f FROM (SELECT repository, number, unnest(changed_files) AS f FROM enriched_prs) WHERE coalesce(f, '') <> '')
    """,
    "p6_found": f"SELECT DISTINCT row_id_a, row_id_b FROM ({_similar('patch')} UNION ALL {_similar('test_patch')})",
    "p6_copies": " UNION ALL ".join(
        f"SELECT CAST({side} AS INTEGER) AS side, row_id, min(row_id) OVER w AS text_id, count(*) OVER w AS same FROM pr_cache "
        f"WHERE len({_WORDS.format(c=c)}) >= 3 WINDOW w AS (PARTITION BY {c}) QUALIFY same > 1"
        for side, c in ((1, "patch"), (2, "test_patch"))
    ),
    "p7_checks": f"""
        SELECT target_id, available, round(needed, 6) AS needed, available < needed AS unmet, true AS as_reported, true AS within FROM ({_NEEDS})
    """,
    "p8_checks": f"""
        SELECT profile, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(ceil(tokens / CAST(cap AS DOUBLE))) AS BIGINT) AS pieces, CAST(0 AS BIGINT) AS "over", true AS bounded
        FROM (SELECT {_TOKENS} AS tokens FROM documents), (SELECT profile, max(capacity_tokens) AS cap FROM packing_profiles GROUP BY 1) WHERE tokens > 0 GROUP BY profile
    """,
    "p9_checks": f"""
        SELECT m.source, CAST(coalesce(t, 0) AS BIGINT) AS tokens, CASE WHEN coalesce(t, 0) * max_repeats < weight * b THEN CAST(coalesce(t, 0) * max_repeats AS BIGINT) END AS served_if_short,
               true AS as_often, true AS within
        FROM mix_targets m LEFT JOIN (SELECT source, sum(tokens) AS t FROM ({_SIZED}) GROUP BY source) s ON s.source = m.source, (SELECT coalesce(sum(tokens), 0) AS b FROM ({_SIZED}))
    """,
    "p5_found": f"SELECT row_id FROM ({_RANKED}) WHERE rn > greatest(1, n // 50)",
    "p5_kept": f"SELECT row_id, repo, pr_number FROM ({_RANKED}) WHERE rn <= greatest(1, n // 50)",
    "p7_found": f"SELECT target_id FROM ({_NEEDS}) WHERE available < needed",
    "p8_found": f"""
        SELECT DISTINCT p.profile, d.doc_id
        FROM (SELECT doc_id, {_TOKENS} AS tokens FROM documents) d
        JOIN packing_profiles p ON d.tokens > p.capacity_tokens
    """,
    "p9_found": f"""
        WITH sized AS (SELECT source, {_TOKENS} AS tokens FROM documents),
             per AS (SELECT source, sum(tokens) AS tokens FROM sized GROUP BY source),
             whole AS (SELECT coalesce(sum(tokens), 0) AS budget FROM sized)
        SELECT m.source
        FROM mix_targets m LEFT JOIN per ON per.source = m.source CROSS JOIN whole
        WHERE coalesce(per.tokens, 0) * m.max_repeats < m.weight * whole.budget
    """,
}
