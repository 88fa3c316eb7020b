"""More queries over the driver's tables: rules and gates, outcomes, caches, tasks, small functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import providers
from millrace.catalog import _BASE, _DOC_PATH, _RUN, _TEST_PATH, _runs, query, values
from millrace.functions import integrity, paths, scalars
from millrace.operators import cache, outcomes, reports, rules, selection
from millrace.plans import dataset
from millrace.plans import tasks as plans
from millrace.runtime import fold, table
from millrace.sources import events as ev
from millrace.sources import tables

# ------------------------------------------------------------ rules and gates
LANGUAGES = ("python", "rust", "go", "typescript")
LIMITS = {"min_stars": 50, "max_files": 12, "min_lines": 5, "max_lines": 800, "min_description": 120}
PENALTIES = {"language": 0.4, "stars": 0.3, "files": 0.25, "lines": 0.2, "docs": 0.3, "tests": 0.3, "description": 0.4, "build": 0.15}
_LENGTH = "(octet_length(encode(trim(coalesce(title, ''), ' ' || chr(10) || chr(9) || chr(13)))) + octet_length(encode(trim(coalesce(body, ''), ' ' || chr(10) || chr(9) || chr(13)))))"
_BROKEN = {
    "language": (f"lower(coalesce(language, '')) NOT IN ('', 'unknown', 'null') AND lower(language) NOT IN {LANGUAGES}", "'language not listed: ' || language", "language"),
    "stars": (f"stars > 0 AND stars < {LIMITS['min_stars']}", "'stars below: ' || stars", "stars"),
    "files": (f"files_changed > {LIMITS['max_files']}", "'files above: ' || files_changed", "files"),
    "few": (f"added_lines > 0 AND added_lines < {LIMITS['min_lines']}", "'lines below: ' || added_lines", "lines"),
    "many": (f"added_lines > {LIMITS['max_lines']}", "'lines above: ' || added_lines", "lines"),
    "docs": (f"len(fs) > 0 AND len(list_filter(fs, lambda f: NOT {_DOC_PATH})) = 0", "'all files are documentation'", "docs"),
    "tests": (f"len(fs) > 0 AND len(list_filter(fs, lambda f: NOT {_TEST_PATH})) = 0", "'all files are tests'", "tests"),
    "short": (f"{_LENGTH} < {LIMITS['min_description']}", f"'description too short: ' || {_LENGTH}", "description"),
    "build": (
        f"len(fs) > 0 AND len(list_filter(fs, lambda f: {_BASE} IN ({', '.join(repr(x) for x in paths.MANIFESTS)}) OR regexp_matches(lower(f), '{paths.SOURCE_SUFFIXES}'))) = 0",
        "'no build files'", "build",
    ),
}
_RULED = (
    "SELECT repository, number, accepted, coalesce(array_to_string(reasons, '; '), '') AS reasons, score FROM (SELECT repository, number, len(r) = 0 AS accepted, r AS reasons, round(greatest(0.0, least(1.0, 1.0 - lost)), 6) AS score FROM (SELECT repository, number, list_filter(["
    + ", ".join(f"CASE WHEN {c} THEN {why} END" for c, why, _ in _BROKEN.values())
    + "], lambda x: x IS NOT NULL) AS r, "
    + " + ".join(f"CASE WHEN {c} THEN {PENALTIES[p]} ELSE 0.0 END" for c, _, p in _BROKEN.values())
    + " AS lost FROM (SELECT *, coalesce(changed_files, []) AS fs FROM enriched_prs)))"
)


def _ruled(spark: SparkSession, d: str) -> DataFrame:
    made = rules.change_rules(languages=LANGUAGES, penalties=PENALTIES, **LIMITS)
    return rules.rule_filter(table(spark, d, "enriched_prs"), made)


@query(_RULED)
def rule_filter(spark: SparkSession, d: str) -> DataFrame:
    return _ruled(spark, d).select("repository", "number", "accepted", F.array_join("reasons", "; ").alias("reasons"), "score")


@query(f"SELECT accepted, count(*) AS n, round(avg(score), 6) AS score FROM ({_RULED}) GROUP BY accepted")
def rule_summary(spark: SparkSession, d: str) -> DataFrame:
    return _ruled(spark, d).groupBy("accepted").agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("score"))


_GATE = {"easy": 30, "hard": 12}


@query("""
    SELECT row_id FROM (SELECT row_id, triage_difficulty AS t, row_number() OVER (PARTITION BY triage_difficulty ORDER BY updated_at NULLS LAST, row_id) AS rn FROM pr_cache)
    WHERE t IS NULL OR (t = 'easy' AND rn <= 30) OR (t = 'hard' AND rn <= 12)
""")
def triage_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pr_cache").select("row_id", "triage_difficulty", "updated_at")
    return rules.level_gate(rows, F.col("triage_difficulty"), [F.asc_nulls_last("updated_at"), "row_id"], quotas=_GATE).select("row_id")


@query("SELECT row_id FROM pr_cache WHERE triage_difficulty IS NULL OR triage_difficulty = 'hard'")
def triage_single(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pr_cache").select("row_id", "triage_difficulty")
    return rules.level_gate(rows, F.col("triage_difficulty"), ["row_id"], only="hard").select("row_id")


@query("SELECT row_id, repo FROM pr_cache WHERE status = 'exported' ORDER BY updated_at, row_id LIMIT 20")
def first_tasks(spark: SparkSession, d: str) -> DataFrame:
    """A limit over all, which is the feature."""
    rows = table(spark, d, "pr_cache").where("status = 'exported'")
    return rules.first_rows(rows, 20, [F.asc_nulls_last("updated_at"), "row_id"]).select("row_id", "repo")


# ------------------------------------------------------------------ the funnel
_COUNTS = {
    "enriched": "status <> 'discovered'",
    "rejected": "status = 'rejected'",
    "triaged": "triage_difficulty IS NOT NULL",
    "triage_easy": "triage_difficulty = 'easy'",
    "triage_medium": "triage_difficulty = 'medium'",
    "triage_hard": "triage_difficulty = 'hard'",
    "extracted": "patch IS NOT NULL",
    "extraction_failed": "triage_difficulty IS NOT NULL AND patch IS NULL",
    "with_tests": "coalesce(test_patch, '') <> ''",
    "scored": "quality_passed IS NOT NULL",
    "quality_passed": "quality_passed",
    "quality_failed": "NOT quality_passed",
    "level_1": "difficulty_score = 1",
    "level_2": "difficulty_score = 2",
    "level_3": "difficulty_score = 3",
    "accepted": "status = 'exported'",
}
_SCORE = "CASE WHEN quality_score IS NOT NULL AND NOT isnan(quality_score) THEN greatest(0.0, least(1.0, quality_score)) END"


@query("SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER ({c}) AS {k}" for k, c in _COUNTS.items()) + f", round(coalesce(avg({_SCORE}), 0.0), 6) AS mean_quality FROM pr_cache")
def funnel_counters(spark: SparkSession, d: str) -> DataFrame:
    out = reports.counters(table(spark, d, "pr_cache"), {k: F.expr(c) for k, c in _COUNTS.items()}, {"mean_quality": F.expr(_SCORE)})
    return out.withColumn("mean_quality", F.round("mean_quality", 6))


@query("SELECT coalesce(lower(trim(language)), 'unknown') AS language, count(*) AS n FROM pr_cache WHERE status = 'exported' GROUP BY 1")
def accepted_languages(spark: SparkSession, d: str) -> DataFrame:
    return reports.counts_by(table(spark, d, "pr_cache").where("status = 'exported'"), language=fold("language"))


@query("""
    SELECT 'day' AS period, CAST(date_trunc('day', ts) AS DATE) AS start, spent, greatest(400000 - spent, 0) AS remaining, spent >= 400000 AS over
    FROM (SELECT date_trunc('day', ts) AS ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS spent FROM events GROUP BY 1)
    UNION ALL
    SELECT 'month', CAST(ts AS DATE), spent, greatest(9000000 - spent, 0), spent >= 9000000
    FROM (SELECT date_trunc('month', ts) AS ts, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS spent FROM events GROUP BY 1)
""".replace(" AS over", ' AS "over"'))
def spending(spark: SparkSession, d: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    return reports.spending(table(spark, d, "events"), F.col("ts"), cents, {"day": 400_000, "month": 9_000_000})


# -------------------------------------------------------------------- outcomes
_FACTS = """
    SELECT CAST(l_orderkey AS VARCHAR) AS task_id,
           CASE l_linenumber % 4 WHEN 0 THEN 'apply' WHEN 1 THEN 'base' ELSE 'after' END AS phase,
           CASE WHEN l_linestatus = 'O' THEN 'f2p' ELSE 'p2p' END AS kind,
           CASE WHEN (l_linestatus = 'O') = (l_linenumber % 4 = 1) THEN CASE WHEN l_quantity > 3 THEN 1 ELSE 0 END
                ELSE CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END END AS exit_code
    FROM lineitem
"""
_ORDERS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, repeat('A long and careful description of what is wrong. ', CAST(o_orderkey % 4 AS INTEGER)) AS prompt,
           CASE WHEN o_orderkey % 7 <> 0 THEN ['pytest a'] ELSE [] END AS fail_to_pass, CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE 'diff' END AS patch
    FROM orders
"""
_JUDGED = f"""
    SELECT o.*, coalesce(early, 0) AS early, coalesce(broken, 0) AS broken, coalesce(tried, 0) AS tried, coalesce(applied, 0) AS applied,
           coalesce(failing, 0) AS failing, coalesce(regressed, 0) AS regressed
    FROM ({_ORDERS}) o LEFT JOIN (
        SELECT task_id, count(*) FILTER (phase = 'base' AND kind = 'f2p' AND exit_code = 0) AS early,
               count(*) FILTER (phase = 'base' AND kind = 'p2p' AND exit_code <> 0) AS broken,
               count(*) FILTER (phase = 'apply') AS tried, count(*) FILTER (phase = 'apply' AND exit_code = 0) AS applied,
               count(*) FILTER (phase = 'after' AND kind = 'f2p' AND exit_code <> 0) AS failing,
               count(*) FILTER (phase = 'after' AND kind = 'p2p' AND exit_code <> 0) AS regressed
        FROM ({_FACTS}) GROUP BY task_id) f ON f.task_id = o.id
"""


def _facts(spark: SparkSession, d: str) -> DataFrame:
    m, f2p, q = F.col("l_linenumber") % 4, F.col("l_linestatus") == "O", F.col("l_quantity")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("task_id"),
        F.when(m == 0, "apply").when(m == 1, "base").otherwise("after").alias("phase"),
        F.when(f2p, "f2p").otherwise("p2p").alias("kind"),
        F.when(f2p == (m == 1), (q > 3).cast("int")).otherwise((q > 45).cast("int")).alias("exit_code"),
    )


def _order_tasks(spark: SparkSession, d: str) -> DataFrame:
    k, none = F.col("o_orderkey"), F.array().cast("array<string>")
    return table(spark, d, "orders").select(
        k.cast("string").alias("id"),
        F.expr("repeat('A long and careful description of what is wrong. ', cast(o_orderkey % 4 as int))").alias("prompt"),
        F.when(k % 7 != 0, F.array(F.lit("pytest a"))).otherwise(none).alias("fail_to_pass"),
        F.when(k % 5 == 0, " ").otherwise("diff").alias("patch"),
        none.alias("test_files"),
    )


@query(f"""
    SELECT id AS task_id, CASE WHEN prompt = '' THEN 'prompt: empty' WHEN len(trim(prompt)) < 100 THEN 'prompt: short' WHEN len(fail_to_pass) = 0 THEN 'no failing tests'
           WHEN early > 0 THEN 'passes before' WHEN broken > 0 THEN 'broken before' WHEN trim(patch) = '' THEN 'empty patch'
           WHEN tried > 0 AND applied = 0 THEN 'not applied' WHEN failing > 0 THEN 'still fails' WHEN regressed > 0 THEN 'regression' ELSE 'passed' END AS outcome
    FROM ({_JUDGED})
""")
def workspace_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.workspace_outcome(_order_tasks(spark, d), _facts(spark, d))


@query(f"SELECT id AS task_id, trim(patch) = '' OR NOT ((tried > 0 AND applied = 0) OR failing > 0 OR regressed > 0) AS accepted FROM ({_JUDGED})")
def dual_commit(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.dual_commit(_order_tasks(spark, d), _facts(spark, d))


_RESULTS = f"""
    SELECT v.task_id, CASE WHEN base = 0 THEN 'setup_error' WHEN insane > 0 THEN 'sanity_fail' WHEN stuck > 0 THEN 'agent_error'
                           WHEN tests > 0 AND passed = tests THEN 'resolved' ELSE 'unresolved' END AS status,
           CAST(o_custkey % 400 AS DOUBLE) - 20 AS agent_seconds
    FROM (SELECT task_id, count(*) FILTER (phase = 'base') AS base,
                 count(*) FILTER (phase = 'base' AND ((kind = 'f2p' AND exit_code = 0) OR (kind = 'p2p' AND exit_code <> 0))) AS insane,
                 count(*) FILTER (phase = 'agent' AND exit_code <> 0 AND lower(coalesce(stderr, '')) LIKE '%timeout%') AS stuck,
                 count(*) FILTER (phase = 'after') AS tests, count(*) FILTER (phase = 'after' AND exit_code = 0) AS passed
          FROM ({_RUN}) GROUP BY task_id) v JOIN orders ON CAST(o_orderkey AS VARCHAR) = v.task_id
"""


@query(
    "SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in outcomes.STATUSES)
    + f", round(coalesce(avg(CASE WHEN agent_seconds > 0 THEN agent_seconds END), 0.0) * 10) / 10 AS mean_agent_seconds FROM ({_RESULTS})"
)
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    took = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("task_id"), ((F.col("o_custkey") % 400).cast("double") - 20).alias("agent_seconds"))
    return outcomes.run_summary(reports.run_status(_runs(spark, d)).join(took, "task_id"))


_EVALUATED = "SELECT meta['difficulty'] AS level, coalesce(quality_passed, false) AS success, CAST(len(coalesce(prompt, '')) AS BIGINT) AS ms FROM swe_tasks"


def _evaluated(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "swe_tasks")
    return t.select(
        F.col("meta")["difficulty"].alias("level"), F.coalesce("quality_passed", F.lit(False)).alias("success"),
        F.length(F.coalesce("prompt", F.lit(""))).cast("bigint").alias("ms"),
    )


@query(f"""
    SELECT CASE WHEN count(*) FILTER (success) > 0 THEN 'success' ELSE 'failed' END AS status, count(*) AS tasks, count(*) FILTER (success) AS successes,
           CAST(count(*) FILTER (success) AS DOUBLE) / count(*) AS success_rate, CAST(sum(ms) // count(*) AS BIGINT) AS mean_ms FROM ({_EVALUATED})
""")
def evaluation_summary(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.evaluation_summary(_evaluated(spark, d))


@query(f"""
    SELECT CASE WHEN lower(level) IN ('easy', 'hard') THEN lower(level) ELSE 'medium' END AS level, count(*) AS tasks,
           round(avg(CAST(success AS DOUBLE)), 6) AS success_rate, CAST(sum(ms) // count(*) AS BIGINT) AS mean_ms FROM ({_EVALUATED}) GROUP BY 1
""")
def evaluation_levels(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.level_rates(_evaluated(spark, d)).withColumn("success_rate", F.round("success_rate", 6))


@query(f"""
    WITH e AS ({_EVALUATED}), w AS (SELECT CAST(count(*) FILTER (success) AS DOUBLE) / count(*) AS r FROM e),
         p AS (SELECT lower(coalesce(level, 'unknown')) AS level, CAST(count(*) FILTER (success) AS DOUBLE) / count(*) AS r FROM e GROUP BY 1)
    SELECT unnest(CASE WHEN r > 0.8 THEN ['too easy: raise the difficulty', 'too easy: add traps and edge cases']
                       WHEN r < 0.2 THEN ['too hard: review the statements', 'too hard: simplify or add context'] ELSE ['well calibrated'] END) AS advice FROM w
    UNION ALL SELECT CASE WHEN level = 'easy' THEN 'easy tasks are too hard' ELSE 'hard tasks are too easy' END FROM p
    WHERE (level = 'easy' AND r < 0.7) OR (level = 'hard' AND r > 0.5)
""")
def evaluation_advice(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.advice(_evaluated(spark, d))


_CHECKS = "SELECT CAST(l_orderkey AS VARCHAR) AS task_id, l_returnflag <> 'R' AS passed, l_linenumber = 1 AS required FROM lineitem"
_CREDIT = "SELECT CAST(o_orderkey AS VARCHAR) AS task_id, (o_orderkey % 11) / 10.0 AS points FROM orders WHERE o_orderkey % 3 = 0"


@query(f"""
    SELECT task_id, coalesce(ok, true) AS passed, round(coalesce(least(share * 0.7 + coalesce(points, 0.0) * 0.3, 1.0), 0.0), 6) AS score
    FROM (SELECT task_id, avg(CAST(passed AS DOUBLE)) AS share, bool_and(passed OR NOT required) AS ok FROM ({_CHECKS}) GROUP BY 1)
    FULL JOIN (SELECT task_id, sum(points) AS points FROM ({_CREDIT}) GROUP BY 1) USING (task_id)
""")
def verifier_points(spark: SparkSession, d: str) -> DataFrame:
    checks = table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("task_id"), (F.col("l_returnflag") != "R").alias("passed"), (F.col("l_linenumber") == 1).alias("required")
    )
    credit = table(spark, d, "orders").where("o_orderkey % 3 = 0").select(
        F.col("o_orderkey").cast("string").alias("task_id"), ((F.col("o_orderkey") % 11) / 10.0).alias("points")
    )
    return outcomes.verifier_score(checks, credit).withColumn("score", F.round("score", 6))


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS task_id, c AS criterion, p AS points
    FROM documents, (VALUES ('any', 0.1, NULL, NULL), ('there', 0.2, 'text', NULL), ('says', 0.3, 'text', 'worker'), ('other', 0.4, 'none', NULL)) v(c, p, f, w)
    WHERE f IS NULL OR (f = 'text' AND (w IS NULL OR contains(coalesce(text, ''), w)))
""")
def partial_credit(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("task_id"), F.lit("text").alias("path"), F.col("text").alias("content"))
    kinds = F.from_json(
        F.lit('[{"criterion":"any","points":0.1},{"criterion":"there","points":0.2,"file":"text"},{"criterion":"says","points":0.3,"file":"text","pattern":"worker"},'
              '{"criterion":"other","points":0.4,"file":"none"}]'),
        "array<struct<criterion:string,points:double,file:string,pattern:string>>",
    )
    criteria = docs.select("task_id", F.explode(kinds).alias("c")).select("task_id", "c.*")
    return outcomes.partial_credit(criteria, docs)


_PATTERNS = "('^[Aa]dd '), ('fix'), ('[0-9]+\\.[0-9]+'), ('never seen anywhere')"


@query(f"""
    SELECT p AS pattern, count(title) AS n FROM (VALUES {_PATTERNS}) v(p) LEFT JOIN pr_cache ON regexp_matches(title, p) GROUP BY p
""")
def command_patterns(spark: SparkSession, d: str) -> DataFrame:
    patterns = values(spark, _PATTERNS.replace("\\", "\\\\"), "pattern")
    return outcomes.pattern_hits(table(spark, d, "pr_cache").select(F.col("title").alias("command")), patterns)


@query("""
    SELECT count(*) AS tasks, count(*) FILTER (coalesce(len(fail_to_pass), 0) > 0 OR coalesce(len(pass_to_pass), 0) > 0) AS with_tests,
           count(*) FILTER (status = 'exported' AND difficulty_score = 1) AS succeeded FROM swe_tasks
""")
def status_flags(spark: SparkSession, d: str) -> DataFrame:
    done = F.when(F.col("status") == "exported", "completed")
    return table(spark, d, "swe_tasks").agg(
        F.count("*").alias("tasks"), F.count_if(outcomes.has_tests(F.col("fail_to_pass"), F.col("pass_to_pass"))).alias("with_tests"),
        F.count_if(outcomes.succeeded(done, F.col("difficulty_score") - 1)).alias("succeeded"),
    )


# ----------------------------------------------------------------------- cache
_REQUESTS = "SELECT lower(trim(repository)) AS key, epoch_us(created_at) AS us FROM gharchive_events WHERE created_at IS NOT NULL AND repository IS NOT NULL"
_TTL = 3600


@query(f"""
    WITH RECURSIVE r AS ({_REQUESTS}), i AS (
        SELECT key, min(us) AS t FROM r GROUP BY key
        UNION ALL SELECT i.key, min(r.us) FROM i JOIN r ON r.key = i.key AND r.us >= i.t + {_TTL * 1_000_000} GROUP BY i.key, i.t)
    SELECT r.key, r.n AS requests, m.n AS misses FROM (SELECT key, count(*) AS n FROM r GROUP BY key) r JOIN (SELECT key, count(*) AS n FROM i GROUP BY key) m USING (key)
""")
def cache_ttl(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "gharchive_events").where("created_at is not null and repository is not null")
    asked = e.select(fold("repository").alias("key"), F.unix_micros("created_at").alias("at"), F.monotonically_increasing_id().alias("id"))
    walked = cache.ttl_hits(asked, _TTL)
    return walked.groupBy("key").agg(F.count("*").alias("requests"), F.count_if(~F.col("hit")).alias("misses"))


@query("""
    SELECT count(*) FILTER (NOT first) AS hits, count(*) FILTER (first) AS misses, count(*) FILTER (first) AS added,
           CAST(sum(CASE WHEN NOT first THEN ceil(octet_length(encode(text)) / 4.0) ELSE 0 END) AS BIGINT) AS tokens_saved,
           CAST(count(*) FILTER (NOT first) AS DOUBLE) / count(*) AS hit_rate
    FROM (SELECT text, row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS first FROM documents WHERE text IS NOT NULL)
""")
def cache_stats(spark: SparkSession, d: str) -> DataFrame:
    from millrace.operators import state

    docs = table(spark, d, "documents").where("text is not null")
    seen = state.first_seen(docs, F.sha2("text", 256), ["doc_id"]).withColumn("tokens", F.ceil(F.octet_length("text") / 4).cast("bigint"))
    return cache.cache_stats(seen, "tokens")


@query("""
    WITH e AS (SELECT lower(trim(repo)) AS key, CAST(max(pr_number) AS BIGINT) AS used, CAST(min(pr_number) AS BIGINT) AS created FROM pr_cache WHERE repo IS NOT NULL AND pr_number IS NOT NULL GROUP BY 1),
         old AS (SELECT key FROM e WHERE 1000000000 - created >= 999999000), alive AS (SELECT * FROM e WHERE 1000000000 - created < 999999000)
    SELECT key FROM old UNION ALL SELECT key FROM (SELECT key, row_number() OVER (ORDER BY used DESC, key) AS rn FROM alive) WHERE rn > 25
""")
def cache_evicted(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "pr_cache").where("repo is not null and pr_number is not null")
    entries = c.groupBy(fold("repo").alias("key")).agg(F.max("pr_number").alias("used"), F.min("pr_number").alias("created"))
    return cache.evicted(entries, 25, now=1_000_000_000, ttl_seconds=999.999)


# ----------------------------------------------------------------------- tasks
_SETUP = "CASE " + " ".join(
    "WHEN lower(language) IN (" + ", ".join(repr(n) for n in names) + f") THEN '{v['install']}|{v['test_cmd']}'" for names, v in plans.SETUP
) + f" ELSE '{plans.NO_SETUP['install']}|{plans.NO_SETUP['test_cmd']}' END"
_TOOLS = "CASE " + " ".join("WHEN lower(language) IN (" + ", ".join(repr(n) for n in names) + f") THEN '{b}|{t}'" for names, b, t in plans.COMMANDS) + " ELSE '' END"


@query(f"SELECT language, {_SETUP} AS setup, {_TOOLS} AS tools FROM (SELECT DISTINCT coalesce(language, '') AS language FROM pr_cache)")
def language_defaults(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pr_cache").select(F.coalesce("language", F.lit("")).alias("language")).distinct()
    setup, tools = plans.setup_for(F.col("language")), plans.commands_for(F.col("language"))
    return rows.select(
        "language", F.concat_ws("|", setup["install"], setup["test_cmd"]).alias("setup"), F.array_join(F.concat(tools["build"], tools["test"]), "|").alias("tools")
    )


@query("""
    SELECT repo || '-' || pr_number AS id, len(regexp_extract_all(patch, '(?m)^diff --git ')) AS files_changed,
           len(list_filter(string_split(patch, chr(10)), lambda x: starts_with(x, '+') AND NOT starts_with(x, '+++'))) AS added_lines,
           len(list_filter(string_split(patch, chr(10)), lambda x: starts_with(x, '-') AND NOT starts_with(x, '---'))) AS removed_lines,
           base_sha AS base_commit, repo || ' (#' || pr_number || '): ' || coalesce(title, '') || chr(10) || chr(10) ||
               CASE WHEN coalesce(body, '') = '' THEN '(no description)' ELSE body END AS prompt
    FROM pr_cache WHERE patch IS NOT NULL AND repo IS NOT NULL AND pr_number IS NOT NULL
""")
def build_tasks(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "pr_cache").where("patch is not null and repo is not null and pr_number is not null")
    changes = c.select("repo", F.col("pr_number").alias("number"), "language", "base_sha", "merge_sha", F.coalesce("title", F.lit("")).alias("title"), "body", F.col("patch").alias("diff"))
    made = plans.build_tasks(changes, "archive")
    counts = [F.col("meta")[c].cast("bigint").alias(c) for c in ("files_changed", "added_lines", "removed_lines")]
    return made.select("id", *counts, "base_commit", "prompt")


_CRITERIA = "array_to_string(list_concat(coalesce(fail_to_pass, []), coalesce(pass_to_pass, [])), chr(10))"


@query(f"""
    SELECT id, CASE WHEN difficulty_score = 0 THEN 'easy' WHEN difficulty_score IN (1, 2) THEN 'medium' ELSE 'hard' END AS level,
           'language:' || lower(language) || '|repo:' || repo AS tags, {_CRITERIA} AS criteria FROM swe_tasks
""")
def synthetic_tasks(spark: SparkSession, d: str) -> DataFrame:
    s = plans.synthetic_tasks(table(spark, d, "swe_tasks"))
    both = F.when(F.col("tags")[0].isNotNull() & F.col("tags")[1].isNotNull(), F.array_join("tags", "|"))
    return s.select("id", "level", both.alias("tags"), F.array_join("criteria", "\n").alias("criteria"))


@query(f"""
    SELECT id AS task_id, 'swe-mining' AS category, CASE WHEN s >= 0.8 THEN 'Hard' WHEN s >= 0.5 THEN 'Medium' ELSE 'Easy' END AS label,
           {_CRITERIA} AS criteria, coalesce(workspace_path, 'out/' || id) AS saved
    FROM (SELECT *, coalesce(quality_score, CAST(difficulty_score AS DOUBLE)) AS s FROM swe_tasks)
""")
def handed_out(spark: SparkSession, d: str) -> DataFrame:
    out = plans.handed_out(table(spark, d, "swe_tasks"))
    return out.select("task_id", "category", "label", F.array_join("criteria", "\n").alias("criteria"), "saved")


@query("SELECT instance_id, CASE lower(difficulty) WHEN 'medium' THEN 2 WHEN 'hard' THEN 3 ELSE 1 END AS difficulty_score FROM dataset_rows")
def level_scores(spark: SparkSession, d: str) -> DataFrame:
    return dataset.scored_levels(table(spark, d, "dataset_rows")).select("instance_id", F.col("difficulty_score").cast("int"))


@query("""
    SELECT repository, number, 'Title: ' || coalesce(title, '') AS head, len(list_filter(coalesce(changed_files, [])[1:50], lambda f: f IS NOT NULL)) AS files
    FROM enriched_prs
""")
def triage_prompts(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "enriched_prs")
    p = plans.triage_prompt(F.col("title"), F.col("body"), F.col("changed_files"))
    listed = F.split_part(p, F.lit("\n\nFiles:\n  "), F.lit(2))
    n = F.when(listed == "", 0).otherwise(F.size(F.split(listed, "\n  ")))
    return e.select("repository", "number", F.regexp_extract(p, r"(?s)\A(.*?)\n\nDescription:\n", 1).alias("head"), n.alias("files"))


@query("SELECT coalesce(lower(trim(difficulty)), 'unknown') AS k, count(*) AS n, '{\"k\":\"' || coalesce(lower(trim(difficulty)), 'unknown') || '\",\"n\":' || count(*) || '}' AS value FROM dataset_rows GROUP BY 1")
def report_lines(spark: SparkSession, d: str) -> DataFrame:
    n = reports.counts_by(table(spark, d, "dataset_rows"), k=fold("difficulty"))
    text = dataset.report_lines(n).select("value", F.get_json_object("value", "$.k").alias("k"), F.get_json_object("value", "$.n").cast("bigint").alias("n"))
    return text.select("k", "n", "value")


@query("""
    SELECT s.id AS task_id FROM swe_tasks s WHERE s.status = 'exported' AND NOT EXISTS (SELECT 1 FROM dataset_rows r WHERE r.instance_id = s.id AND r.difficulty_score = 1)
""")
def unpublished(spark: SparkSession, d: str) -> DataFrame:
    folders = table(spark, d, "swe_tasks").select(F.col("id").alias("task_id"), (F.col("status") == "exported").alias("done"))
    marks = table(spark, d, "dataset_rows").where("difficulty_score = 1").select(F.col("instance_id").alias("task_id"))
    return dataset.unpublished(folders, marks).select("task_id")


@query("""
    SELECT lower(trim(e.repository)) AS repo, e.number, coalesce(c.level, CASE WHEN e.files > 5 THEN 'hard' ELSE 'easy' END) AS level
    FROM (SELECT DISTINCT lower(trim(repository)) AS repository, number, max(coalesce(files_changed, 0)) AS files FROM enriched_prs GROUP BY 1, 2) e
    LEFT JOIN (SELECT lower(trim(repo)) AS repo, pr_number, min(triage_difficulty) AS level FROM pr_cache WHERE triage_difficulty IS NOT NULL GROUP BY 1, 2) c
      ON c.repo = e.repository AND c.pr_number = e.number
""")
def provider_chain(spark: SparkSession, d: str) -> DataFrame:
    """Recorded answers first, a rule for the rest."""
    e = table(spark, d, "enriched_prs").groupBy(fold("repository").alias("repo"), "number").agg(F.max(F.coalesce("files_changed", F.lit(0))).alias("files"))
    known = table(spark, d, "pr_cache").where("triage_difficulty is not null and repo is not null and pr_number is not null").select(
        fold("repo").alias("repo"), F.col("pr_number").alias("number"), F.col("triage_difficulty").alias("answer")
    )
    first = providers.answered(e, ["repo", "number"], providers.recorded(known), "level")
    ruled = providers.answered(first, ["repo", "number"], providers.by_rule(F.when(F.col("files") > 5, "hard").otherwise("easy")), "rule")
    return ruled.select("repo", "number", F.coalesce("level", "rule").alias("level"))


# --------------------------------------------------------------------- searches
_FETCHED = "(1, 1, 200, 100), (1, 2, 200, 40), (1, 3, 200, 0), (1, 4, 200, 7), (2, 1, 403, 5), (2, 2, 200, 5), (3, 1, 200, 9), (3, 2, 429, 9), (3, 3, 200, 9), (4, 1, 200, 3)"


@query(f"""
    SELECT f.* FROM (VALUES {_FETCHED}) f(search_id, page, status, items)
    WHERE NOT EXISTS (SELECT 1 FROM (VALUES {_FETCHED}) g(search_id, page, status, items)
                      WHERE g.search_id = f.search_id AND g.page <= f.page AND (g.items = 0 OR g.status IN (403, 429)))
""")
def search_kept_pages(spark: SparkSession, d: str) -> DataFrame:
    return ev.kept_pages(values(spark, _FETCHED, "search_id, page, status, items"))


@query("""
    SELECT n AS max_results, unnest(range(1, CAST(ceil(n / CAST(least(n, 100) AS DOUBLE)) AS BIGINT) + 1)) AS page, CAST(least(n, 100) AS INTEGER) AS per_page
    FROM (VALUES (250), (30), (100), (101)) t(n)
""")
def search_pages(spark: SparkSession, d: str) -> DataFrame:
    return ev.search_pages(values(spark, "(250), (30), (100), (101)", "max_results")).select("max_results", F.col("page").cast("bigint"), "per_page")


@query("""
    SELECT doc_id, 'search-' || r || '-' || doc_id AS id, r AS repository, 'merged' AS action, doc_id AS pull_number, true AS has_org
    FROM (SELECT doc_id, concat_ws('/', string_split(url, '/')[4], string_split(url, '/')[5]) AS r FROM documents WHERE len(string_split(url, '/')) >= 5)
""")
def search_items(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "documents").select(
        F.col("url").alias("html_url"), F.col("doc_id").alias("number"), F.lit(None).cast("string").alias("title"), F.col("text").alias("body"), F.lit("u").alias("user")
    )
    return ev.search_events(items).select(F.col("pull_number").alias("doc_id"), "id", "repository", "action", "pull_number", "has_org")


@query("SELECT id, coalesce(repository, 'NULL') || '|' || coalesce(action, 'NULL') || '|' || coalesce(language_hint, '') AS payload FROM gharchive_events")
def filter_payload(spark: SparkSession, d: str) -> DataFrame:
    m = ev.filter_payload(F.col("repository"), F.col("action"), F.col("language_hint"))
    part = lambda k: F.coalesce(m[k], F.lit("NULL"))
    return table(spark, d, "gharchive_events").select("id", F.concat_ws("|", part("repo"), part("action"), m["language"]).alias("payload"))


# -------------------------------------------------------------- small functions
@query(
    "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(repr(x) for x in (k, *v)) + ")" for k, v in scalars.LEVELS.items()) + ") t("
    + ", ".join(c.split()[0] for c in scalars.LEVEL_COLUMNS.split(", ")) + ")"
)
def level_constants(spark: SparkSession, d: str) -> DataFrame:
    t = scalars.level_table(spark)
    return t.select(*[F.col(f.name).cast("decimal(3,2)") if f.name.endswith(("from", "to", "rate")) and f.dataType.typeName() == "double" else
                      F.col(f.name).cast("decimal(3,1)") if f.dataType.typeName() == "double" else F.col(f.name) for f in t.schema.fields])


_LV = "CASE o_orderkey % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END"
_PTS = "CASE l WHEN 'easy' THEN 10.0 WHEN 'medium' THEN 25.0 ELSE 50.0 END"


@query(f"""
    SELECT o_orderkey AS k, round(CASE WHEN NOT ok THEN {_PTS} * 0.5 * greatest(0.0, least(1.0, p))
               ELSE {_PTS} + CASE WHEN t < x AND x > 0 THEN CASE l WHEN 'easy' THEN 5.0 WHEN 'medium' THEN 15.0 ELSE 30.0 END * least((1.0 - t / x) / 0.5, 1.0) ELSE 0.0 END
                    + CASE WHEN v THEN {_PTS} * 0.1 ELSE 0.0 END END, 6) AS score,
           CAST(least(greatest(m * 60, CASE l WHEN 'easy' THEN 180 WHEN 'medium' THEN 480 ELSE 900 END), CASE l WHEN 'easy' THEN 360 WHEN 'medium' THEN 900 ELSE 3600 END) AS BIGINT) AS seconds,
           CASE l WHEN 'easy' THEN 6 WHEN 'medium' THEN 17 ELSE 48 END AS steps,
           CASE WHEN q < 0.4 THEN 'easy' WHEN q < 0.6 THEN 'medium' ELSE 'hard' END AS executor_level,
           CASE WHEN q < 0.34 THEN 'easy' WHEN q < 0.67 THEN 'medium' ELSE 'hard' END AS level
    FROM (SELECT o_orderkey, {_LV} AS l, o_orderkey % 4 <> 0 AS ok, CAST(o_custkey % 15 AS DOUBLE) / 10.0 AS p, CAST(o_custkey % 900 AS DOUBLE) AS t,
                 CAST(o_orderkey % 800 AS DOUBLE) AS x, o_orderkey % 2 = 0 AS v, o_custkey % 70 AS m, CAST(o_custkey % 101 AS DOUBLE) / 100.0 AS q FROM orders)
""")
def task_scores(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    level = F.when(k % 3 == 0, "easy").when(k % 3 == 1, "medium").otherwise("hard")
    q = (c % 101).cast("double") / 100.0
    score = scalars.task_score(level, k % 4 != 0, (c % 15).cast("double") / 10.0, (c % 900).cast("double"), (k % 800).cast("double"), k % 2 == 0)
    return table(spark, d, "orders").select(
        k.alias("k"), F.round(score, 6).alias("score"), scalars.expected_seconds(level, c % 70).alias("seconds"), scalars.expected_steps(level).alias("steps"),
        scalars.level_of_score(q, 0.4, 0.6).alias("executor_level"), scalars.level_of_score(q).alias("level"),
    )


_MODELS = "('moonshotai/kimi-k2.5', 'true'), ('kimi-k2-preview', 'true'), ('akimi-k2', 'false'), ('kimi-k2x', 'false'), ('openai/o1-mini', 'true'), ('x/openai/o1', 'false'), ('pro1-turbo', 'false'), ('o1-mini', 'true'), ('Deep-Thinking', 'true'), ('m-reasoning-2', 'true'), ('thinking', 'false'), ('vendor/deepseek-r1', 'true'), ('plain', 'false')"


@query(f"""
    SELECT m AS model, w = 'true' AS reasons, CASE WHEN w = 'true' THEN greatest(coalesce(a, 4000) + 8000, 16000) ELSE a END AS room, a AS asked
    FROM (VALUES {_MODELS}) t(m, w), (VALUES (NULL), (500), (9000)) u(a)
""")
def model_flags(spark: SparkSession, d: str) -> DataFrame:
    asked = F.explode(F.array(F.lit(None).cast("int"), F.lit(500), F.lit(9000))).alias("asked")
    m = values(spark, _MODELS, "model, want").select("model", asked)
    return m.select("model", scalars.reasons(F.col("model")).alias("reasons"), scalars.token_limit(F.col("model"), F.col("asked"), F.lit(False)).alias("room"), "asked")


_ERRORS = "('request', 'read timeout', 0), ('request', 'bad url', 0), ('request', 'Connection refused', 0), ('rate_limited', '', 0), ('api', '', 429), ('api', '', 503), ('api', '', 404), ('parse', 'timeout', 500)"


@query(f"""
    SELECT k AS kind, m AS message, c AS code, (k = 'rate_limited') OR (k = 'api' AND (c >= 500 OR c = 429))
           OR (k = 'request' AND (contains(m, 'timeout') OR contains(m, 'connection') OR contains(m, 'temporarily') OR contains(m, 'Connection refused'))) AS again
    FROM (VALUES {_ERRORS}) t(k, m, c)
""")
def transient_errors(spark: SparkSession, d: str) -> DataFrame:
    e = values(spark, _ERRORS, "kind, message, code")
    return e.select("kind", "message", "code", scalars.transient(F.col("kind"), F.col("message"), F.col("code")).alias("again"))


_OFFER = "('a', 0.9, 0.2, 0.4), ('b', 0.3, 0.95, 0.1), ('c', 0.5, 0.5, 0.99)"


@query(f"""
    SELECT row_id, arg_max(name, fit ORDER BY fit DESC, name) AS model FROM (
        SELECT row_id, name, CASE WHEN h THEN CASE WHEN code THEN coding * 3.0 ELSE 0.0 END + CASE WHEN l = 'hard' THEN reasoning * 2.0 ELSE 0.0 END
                                              + CASE WHEN l = 'easy' THEN speed * 1.5 ELSE 0.0 END ELSE coding + reasoning + speed END AS fit
        FROM (SELECT row_id, triage_difficulty AS l, triage_difficulty IS NOT NULL AS h, coalesce(files_changed, 0) > 3 AS code FROM pr_cache), (VALUES {_OFFER}) o(name, coding, reasoning, speed))
    GROUP BY row_id
""".replace("arg_max(name, fit ORDER BY fit DESC, name)", "first(name ORDER BY fit DESC, name)"))
def route_best(spark: SparkSession, d: str) -> DataFrame:
    """The best of a few registered models per row: each is a column, so nothing is multiplied."""
    registered = values(spark, "('a'), ('b'), ('c')", "name")
    offers = values(spark, _OFFER + ", ('unregistered', 1.0, 1.0, 1.0)", "name, coding, reasoning, speed").join(registered, "name", "left_semi").orderBy("name").collect()
    rows = table(spark, d, "pr_cache")
    level, code = F.col("triage_difficulty"), F.coalesce("files_changed", F.lit(0)) > 3
    fits = [
        F.struct(-F.round(scalars.model_fit(code, level, level.isNotNull(), *[F.lit(float(o[c])) for c in ("coding", "reasoning", "speed")]), 9), F.lit(o["name"]).alias("name"))
        for o in offers
    ]
    return rows.select("row_id", F.least(*fits)["name"].alias("model"))


_SPELLED = "('Claude-Code', 'claude_code', 'custom'), ('base', 'base', 'custom'), ('aider', 'aider', 'custom'), ('FileExists', NULL, 'file_exists'), ('exit_code', NULL, 'exit_code'), ('OUTPUTMATCHES', NULL, 'output_matches'), ('zzz', NULL, 'custom')"


@query(f"SELECT v AS spelled, a AS agent, c AS checks, v = 'base' AS cached FROM (VALUES {_SPELLED}) t(v, a, c)")
def spelled_kinds(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("spelled")
    rows = values(spark, _SPELLED, "spelled, a, c")
    role = F.when(v == "base", "system").when(v == "zzz", "tool").otherwise("user")
    return rows.select("spelled", scalars.agent_kind(v).alias("agent"), scalars.check_kind(v).alias("checks"), scalars.cacheable(role).alias("cached"))


@query("""
    SELECT p_partkey AS k, CASE WHEN mb >= 1024 THEN (mb // 1024) || 'G' ELSE mb || 'M' END AS memory, CAST(p_size % 8 * 50000 AS BIGINT) AS quota,
           '/h/' || p_partkey || ':/c' || CASE WHEN p_size % 2 = 0 THEN ':ro' ELSE '' END AS volume, p_partkey % 50001 + 10000 AS port,
           replace(replace(replace(p_name || '"$' || chr(92), chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), '$', chr(92) || '$') AS escaped,
           regexp_matches(p_brand, '^[A-Za-z0-9_]*$') AS tool, p_brand <> '' AND regexp_full_match(p_brand, '[\\p{L}\\p{N}_.:+-]+') AS package
    FROM (SELECT *, CAST(p_partkey * p_size * 64 AS BIGINT) AS mb FROM part)
""")
def sizes_and_names(spark: SparkSession, d: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    size = k.cast("bigint") * n * 64 * (1 << 20)
    text = F.concat("p_name", F.lit('"$\\'))
    return table(spark, d, "part").select(
        k.alias("k"), scalars.memory_text(size).alias("memory"), scalars.cpu_quota((n % 8) / 2.0).alias("quota"),
        scalars.volume_text(F.concat(F.lit("/h/"), k.cast("string")), F.lit("/c"), n % 2 == 0).alias("volume"), scalars.port_of(k).alias("port"),
        scalars.env_escape(text).alias("escaped"), scalars.tool_name(F.col("p_brand")).alias("tool"), scalars.package_name(F.col("p_brand")).alias("package"),
    )


_ANSWERS = (
    "('{\"error\": \"no file\"}', ''), ('{\"output\": \"a\", \"total_lines\": 9}', ''), ('{\"output\": \"b\", \"total_lines\": 9, \"truncated\": true, \"shown_lines\": 2}', ''),"
    " ('{\"output\": \"c\"}', ''), ('{\"x\": 1}', ''), ('plain', 'e'), ('', 'bad'), ('', '')"
)


@query(f"""
    SELECT o AS stdout, e AS stderr, CASE WHEN o <> '' THEN CASE WHEN json_valid(o) THEN coalesce(o ->> '$.error', (o ->> '$.output') ||
               CASE WHEN (o ->> '$.total_lines') IS NULL THEN '' WHEN coalesce(CAST(o ->> '$.truncated' AS BOOLEAN), false)
                    THEN chr(10) || chr(10) || '[Showing ' || coalesce(o ->> '$.shown_lines', '0') || '/' || (o ->> '$.total_lines') || ' lines. Use offset/limit to see more.]'
                    ELSE chr(10) || chr(10) || '[' || (o ->> '$.total_lines') || ' total lines]' END, o) ELSE o END
           WHEN e <> '' THEN 'Error: ' || e ELSE 'No output' END AS answer
    FROM (VALUES {_ANSWERS}) t(o, e)
""")
def tool_answers(spark: SparkSession, d: str) -> DataFrame:
    rows = values(spark, _ANSWERS, "stdout, stderr")
    return rows.select("stdout", "stderr", scalars.tool_answer(F.col("stdout"), F.col("stderr")).alias("answer"))


@query("""
    SELECT row_id, CASE row_id % 3 WHEN 1 THEN 'truncated' WHEN 2 THEN 'not_found' END AS error,
           CASE row_id % 3 WHEN 1 THEN title[:100] WHEN 2 THEN trim(title)[:50] END AS preview
    FROM pr_cache WHERE title IS NOT NULL AND strlen(title) = len(title)
""")
def json_errors(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("row_id") % 3
    status = F.when(k == 1, "truncated").when(k == 2, "not_found").otherwise("success")
    rows = table(spark, d, "pr_cache").where("title is not null and octet_length(title) = length(title)")
    e = scalars.json_error(status, F.col("title"), F.col("title"))
    return rows.select("row_id", e.alias("e")).select("row_id", "e.error", "e.preview")


@query("""
    SELECT id, '<!-- CANARY-X [loc:' || replace(coalesce(language, '') || ' file', ' ', '_') || '] -->' || chr(10) || coalesce(prompt, '') AS marked,
           sha256('7|' || id)[1:32] AS session, sha256('7|' || id)[57:64] AS suffix FROM swe_tasks
""")
def marked_tasks(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "swe_tasks")
    place = F.concat(F.coalesce("language", F.lit("")), F.lit(" file"))
    run = scalars.run_values(F.col("id"), F.col("created_at"), F.lit(1), 7)
    return t.select(
        "id", scalars.embed_canary(F.coalesce("prompt", F.lit("")), F.lit("CANARY-X"), place).alias("marked"), run["session_id"].alias("session"), run["random_suffix"].alias("suffix")
    )


_IMAGE = "CASE WHEN contains(t, 'python') THEN 'python:3.11-slim' WHEN contains(t, 'node') OR contains(t, 'javascript') THEN 'node:20-slim' WHEN contains(t, 'rust') THEN 'rust:1.75-slim' WHEN contains(t, 'go') THEN 'golang:1.21-alpine' ELSE 'base' END"


@query(f"SELECT id, {_IMAGE} AS image FROM (SELECT id, 'language:' || lower(coalesce(language, '')) AS t FROM swe_tasks)")
def base_images(spark: SparkSession, d: str) -> DataFrame:
    tags = F.array(F.concat(F.lit("language:"), F.coalesce("language", F.lit(""))))
    return table(spark, d, "swe_tasks").select("id", scalars.base_image(tags, F.lit("swe"), "base").alias("image"))


@query(r"""
    WITH f AS (SELECT 't' || (row_id % 50) AS task_id, 'tests/f' || row_id || CASE WHEN row_id % 2 = 0 THEN '.sh' ELSE '.py' END AS path,
                      CASE row_id % 5 WHEN 0 THEN '' WHEN 1 THEN '#!/bin/bash' || chr(10) || 'bash ./tests/f' || (row_id + 50) || '.sh' WHEN 2 THEN 'python tests/none.py x' ELSE coalesce(title, '') END AS content
               FROM pr_cache)
    SELECT task_id, path, 'no shebang' AS issue, CAST(NULL AS VARCHAR) AS ref FROM f WHERE path LIKE '%.sh' AND NOT starts_with(ltrim(content), '#!')
    UNION ALL SELECT task_id, path, 'empty', NULL FROM f WHERE path LIKE '%.sh' AND trim(content) = ''
    UNION ALL SELECT task_id, path, 'not submitted', ref FROM (
        SELECT DISTINCT task_id, path, regexp_replace(t, '^\./', '') AS ref FROM (SELECT task_id, path, unnest(regexp_split_to_array(content, '\s+')) AS t FROM f)
        WHERE regexp_matches(t, '^(\./)?tests/.*\.(py|js|ts|sh)$')) r
        WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.task_id = r.task_id AND f.path = r.ref)
""")
def script_issues(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("row_id")
    content = (
        F.when(k % 5 == 0, "").when(k % 5 == 1, F.concat(F.lit("#!/bin/bash\nbash ./tests/f"), (k + 50).cast("string"), F.lit(".sh")))
        .when(k % 5 == 2, "python tests/none.py x").otherwise(F.coalesce("title", F.lit("")))
    )
    files = table(spark, d, "pr_cache").select(
        F.concat(F.lit("t"), (k % 50).cast("string")).alias("task_id"),
        F.concat(F.lit("tests/f"), k.cast("string"), F.when(k % 2 == 0, ".sh").otherwise(".py")).alias("path"), content.alias("content"),
    )
    return scalars.script_issues(files)


@query("""
    SELECT s.id AS output_id, s.id AS task_id, 1.0 AS confidence FROM swe_tasks s WHERE TRY_CAST(regexp_extract(s.id, '([0-9]+)$', 1) AS BIGINT) % 2 = 0
""")
def canary_hits(spark: SparkSession, d: str) -> DataFrame:
    """Outputs that hold their task's canary, and others that hold none; no other pairs come out."""
    from millrace.functions.integrity import canary_id

    t = table(spark, d, "swe_tasks")
    c = canary_id(F.col("id"), 42)
    even = F.regexp_extract("id", r"([0-9]+)$", 1).try_cast("bigint") % 2 == 0
    outputs = t.select(F.col("id").alias("output_id"), F.when(even, F.concat(F.lit("done "), F.lower(c), F.lit("."))).otherwise("nothing").alias("text"))
    found = outcomes.canary_hits(outputs, t.select(F.col("id").alias("task_id"), c.alias("canary")))
    return found.withColumn("confidence", F.col("confidence").cast("decimal(2,1)"))


# ------------------------------------------------------- more joins and small ones
@query("""
    SELECT row_id FROM (SELECT row_id, q.quota, row_number() OVER (PARTITION BY triage_difficulty ORDER BY updated_at NULLS LAST, row_id) AS rn
                        FROM pr_cache JOIN (VALUES ('easy', 15), ('medium', 7), ('none', 3)) q(level, quota) ON q.level = triage_difficulty) WHERE rn <= quota
""")
def quota_table(spark: SparkSession, d: str) -> DataFrame:
    quotas = values(spark, "('easy', 15), ('medium', 7), ('none', 3)", "level, quota")
    rows = table(spark, d, "pr_cache").select("row_id", "triage_difficulty", "updated_at")
    return selection.take_quota_table(rows, quotas, F.col("triage_difficulty"), [F.asc_nulls_last("updated_at"), "row_id"]).select("row_id")


@query("SELECT sum(q) AS wanted FROM (VALUES (40), (25), (10)) t(q)")
def quota_total(spark: SparkSession, d: str) -> DataFrame:
    parsed = selection.parse_quotas("easy:40, MEDIUM : 25,hard:9,hard:10")
    return spark.createDataFrame(list(parsed.items()), "level string, quota bigint").agg(F.sum("quota").alias("wanted"))


@query(f"""
    SELECT task_id, count(*) FILTER (phase = 'after' AND kind = 'f2p' AND exit_code = 0) || '/' || count(*) FILTER (phase = 'after' AND kind = 'f2p') AS f2p,
           count(*) FILTER (phase = 'after' AND kind = 'p2p' AND exit_code = 0) || '/' || count(*) FILTER (phase = 'after' AND kind = 'p2p') AS p2p
    FROM ({_FACTS}) GROUP BY task_id
""")
def test_ratios(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.test_ratio(_facts(spark, d))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS task_id, k AS check_id, coalesce(CASE k WHEN 'command_succeeds' THEN l.code = 0 WHEN 'command_output' THEN contains(l.said, 'R') WHEN 'exit_code' THEN l.code = 2 END, false) AS passed
    FROM orders CROSS JOIN (VALUES ('command_succeeds'), ('command_output'), ('exit_code')) v(k)
    LEFT JOIN (SELECT l_orderkey, max(l_returnflag) AS said, CAST(max(l_linenumber) % 3 AS INTEGER) AS code FROM lineitem WHERE l_orderkey % 4 <> 0 GROUP BY 1) l ON l_orderkey = o_orderkey
""")
def command_checks(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").where("l_orderkey % 4 != 0").groupBy(F.col("l_orderkey").cast("string").alias("task_id"))
    results = lines.agg(F.lit("run").alias("command"), F.max("l_returnflag").alias("stdout"), (F.max("l_linenumber") % 3).cast("int").alias("exit_code"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(e).alias("expected")) for k, e in (("command_succeeds", ""), ("command_output", "R"), ("exit_code", "2"))])).alias("k")
    checks = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("task_id"), kinds).select(
        "task_id", F.col("k.kind").alias("check_id"), "k.kind", F.lit("run").alias("command"), "k.expected"
    )
    return outcomes.run_checks(checks, results)


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS run_id, coalesce(s.n, 0) AS steps, s.score, coalesce(a.n, 0) AS artifacts FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS score FROM orders GROUP BY 1) s ON s.o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1) a ON a.o_custkey = c_custkey
""")
def trace_overview(spark: SparkSession, d: str) -> DataFrame:
    run = lambda c: F.col(c).cast("string").alias("run_id")
    o = table(spark, d, "orders").select(run("o_custkey"), F.col("o_totalprice").alias("score"), "o_orderkey")
    return outcomes.traces(table(spark, d, "customer").select(run("c_custkey")), o, o, o.where("o_orderkey % 3 = 0"))


@query("""
    SELECT k, round(greatest(0.0, least(1.0, p * CASE WHEN c >= 0.95 THEN 0.1 WHEN c = 0.6 THEN 0.7 ELSE 1.0 END * CASE WHEN c > 0.5 THEN 1.0 - (c - 0.5) * 0.4 ELSE 1.0 END)), 6) AS score
    FROM (SELECT o_orderkey AS k, CAST(o_custkey % 10 AS DOUBLE) / 10 AS p, CAST(CASE o_orderkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.95 WHEN 2 THEN 0.6 ELSE 0.0 END AS DOUBLE) AS c FROM orders)
""")
def integrity_scores(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("o_orderkey") % 4
    sure = F.when(m == 0, 1.0).when(m == 1, 0.95).when(m == 2, 0.6).otherwise(0.0)
    found = F.struct((m <= 1).alias("contaminated"), (m == 2).alias("partial_match"), sure.alias("confidence"))
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 10 / 10.0).alias("p"), found.alias("f"))
    return o.select(F.col("o_orderkey").alias("k"), F.round(integrity.combined_score(F.col("p"), F.col("f")), 6).alias("score"))


@query("""
    SELECT 'archive' AS origin, id, repository, pull_number FROM gharchive_events
    UNION ALL SELECT 'search', 'search-' || r || '-' || doc_id, r, doc_id
    FROM (SELECT doc_id, concat_ws('/', string_split(url, '/')[4], string_split(url, '/')[5]) AS r FROM documents WHERE len(string_split(url, '/')) >= 5)
""")
def union_search(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "documents").select(
        F.col("url").alias("html_url"), F.col("doc_id").alias("number"), F.lit(None).cast("string").alias("title"), F.col("text").alias("body"), F.lit("u").alias("user")
    )
    archive = table(spark, d, "gharchive_events").withColumn("origin", F.lit("archive"))
    both = tables.union_all([archive, ev.search_events(items).withColumn("origin", F.lit("search"))])
    return both.select("origin", "id", "repository", "pull_number")


@query("""
    SELECT repository, number, array_to_string(list_concat(list_transform(a, lambda f: f || '=1'), list_transform(list_filter(b, lambda f: NOT list_contains(a, f)), lambda f: f || '=2')), ' ') AS files
    FROM (SELECT DISTINCT repository, number, coalesce(list_filter(changed_files, lambda f: f IS NOT NULL), [])[1:2] AS a, coalesce(list_filter(changed_files, lambda f: f IS NOT NULL), []) AS b FROM enriched_prs)
""")
def merged_files(spark: SparkSession, d: str) -> DataFrame:
    named = F.filter(F.coalesce("changed_files", F.array().cast("array<string>")), lambda f: f.isNotNull())
    e = table(spark, d, "enriched_prs").select("repository", "number", named.alias("b")).distinct()
    as_files = lambda c, x: F.transform(c, lambda f: F.struct(f.alias("path"), F.lit(x).alias("content")))
    merged = selection.merge_files(as_files(F.slice("b", 1, 2), "1"), as_files(F.col("b"), "2"))
    return e.select("repository", "number", F.array_join(F.transform(merged, lambda f: F.concat(f["path"], F.lit("="), f["content"])), " ").alias("files"))


_VERSIONS = "('1.2.3', '1.2.2'), ('v1.10.0', '1.9.9'), ('1.0.0', '1.0.0'), ('0.9', '1.0.0'), ('2.0.0-rc1', '1.9.0'), ('x', '1.0.0')"


@query("""
    SELECT * FROM (VALUES ('1.2.3', '1.2.2', true, '1.0 2.0'), ('v1.10.0', '1.9.9', true, '1.0 2.0'), ('1.0.0', '1.0.0', false, '1.0 2.0'), ('0.9', '1.0.0', false, '1.0 2.0'),
                          ('2.0.0-rc1', '1.9.0', true, '1.0 2.0'), ('x', '1.0.0', NULL, '1.0 2.0')) t(version, than, is_newer, waits)
""")
def versions_and_retries(spark: SparkSession, d: str) -> DataFrame:
    v = values(spark, _VERSIONS, "version, than")
    waits = F.array_join(F.transform(scalars.retry_delays(F.lit(3)), lambda x: x.cast("string")), " ")
    return v.select("version", "than", scalars.newer(F.col("version"), F.col("than")).alias("is_newer"), waits.alias("waits"))


@query("""
    SELECT user_id, round(n / s * 3600, 6) AS per_hour, round((500 - n) / (n / s), 6) AS eta_seconds, s - l >= 600 AS stalled
    FROM (SELECT user_id, CAST(count(*) AS DOUBLE) AS n, CAST(sum(event_id % 97) + 1 AS DOUBLE) AS s, CAST(max(event_id % 97) AS DOUBLE) AS l FROM events GROUP BY 1)
""")
def run_pace(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "events").groupBy("user_id").agg(
        F.count("*").cast("double").alias("n"), (F.sum(F.col("event_id") % 97) + 1).cast("double").alias("s"), F.max(F.col("event_id") % 97).cast("double").alias("l")
    )
    p = g.select("user_id", scalars.pace(F.col("n"), F.lit(500.0), F.col("s"), F.col("l")).alias("p"))
    return p.select("user_id", F.round("p.per_hour", 6).alias("per_hour"), F.round("p.eta_seconds", 6).alias("eta_seconds"), F.col("p.stalled").alias("stalled"))


@query("""
    SELECT count(*) AS outputs, count(*) FILTER (contains(body, 'TASK COMPLETE') OR contains(body, 'drops the')) AS done
    FROM pr_cache WHERE body IS NOT NULL
""")
def said_done(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "pr_cache").where("body is not null")
    return c.agg(F.count("*").alias("outputs"), F.count_if(outcomes.says_done(F.col("body"), (*outcomes.DONE, "drops the"))).alias("done"))


@query("""
    SELECT CAST(k AS VARCHAR) AS task_id, arg_max(q, n) AS quantity, max(n) AS attempt
    FROM (SELECT l_orderkey AS k, l_linenumber AS n, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2) GROUP BY 1
""")
def last_attempts(spark: SparkSession, d: str) -> DataFrame:
    once = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("task_id"), F.col("l_linenumber").alias("attempt")).agg(F.max("l_quantity").alias("quantity"))
    return outcomes.last_attempts(once, ["task_id"]).select("task_id", "quantity", "attempt")
