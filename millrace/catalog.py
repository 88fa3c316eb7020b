"""The queries over the driver's tables and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import integrity, jsonx, paths, text
from millrace.operators import dedup, reports, rules, selection, state, tasks
from millrace.plans import dataset
from millrace.runtime import fold, table
from millrace.sources import events as ev
from millrace.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def values(spark: SparkSession, rows: str, columns: str) -> DataFrame:
    """A small inline table, written so that both engines read it."""
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


STATUSES = ("discovered", "enriched", "pre_classified", "extracted", "scored", "exported", "rejected")
QUOTAS = {"easy": 40, "medium": 25, "hard": 10}

# ------------------------------------------------------------------- messages
_MESSAGES = r"""
    SELECT TRY_CAST(regexp_extract(id, '([0-9]+)', 1) AS BIGINT) AS event_no,
           lower(regexp_replace(repository, '^\s+|\s+$', '', 'g')) AS repository, pull_number, count(*) AS copies
    FROM gharchive_events
    WHERE TRY_CAST(regexp_extract(id, '([0-9]+)', 1) AS BIGINT) IS NOT NULL
    GROUP BY ALL
"""


@query(f"SELECT event_no, repository, pull_number FROM ({_MESSAGES}) WHERE copies > 1")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    kept = dedup.kept_messages(table(spark, d, "gharchive_events"))
    return kept.where("copies > 1").select("event_no", "repository", "pull_number")


@query(_MESSAGES)
def p1_messages(spark: SparkSession, d: str) -> DataFrame:
    return dedup.message_counts(table(spark, d, "gharchive_events"))


@query(f"""
    SELECT count(*) AS "rows", (SELECT count(*) FROM ({_MESSAGES})) AS messages FROM (
        SELECT 1 FROM ({_MESSAGES})
        UNION ALL SELECT 1 FROM gharchive_events WHERE TRY_CAST(regexp_extract(id, '([0-9]+)', 1) AS BIGINT) IS NULL)
""")
def p1_kept_counts(spark: SparkSession, d: str) -> DataFrame:
    kept = dedup.keep_one(table(spark, d, "gharchive_events"))
    return kept.agg(F.count("*").alias("rows"), F.count(dedup.event_number("id")).alias("messages"))


@query(r"""
    SELECT TRY_CAST(regexp_extract(id, '([0-9]+)', 1) AS BIGINT) AS event_no,
           lower(regexp_replace(repository, '^\s+|\s+$', '', 'g')) AS repository, pull_number, count(*) AS copies,
           min(ingested_at) AT TIME ZONE 'UTC' AS ingested_at,
           arg_min(batch_id, struct_pack(a := ingested_at IS NULL, b := ingested_at, c := batch_id IS NULL, d := batch_id)) AS batch_id
    FROM gharchive_events WHERE TRY_CAST(regexp_extract(id, '([0-9]+)', 1) AS BIGINT) IS NOT NULL
    GROUP BY ALL
""")
def p1_first(spark: SparkSession, d: str) -> DataFrame:
    """The delivery that is kept of each message is its first."""
    kept = dedup.kept_messages(table(spark, d, "gharchive_events"))
    return kept.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query()
def p1_kept(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_one(table(spark, d, "gharchive_events"))


# --------------------------------------------------------------------- sources
@query("""
    SELECT DISTINCT strftime(created_at AT TIME ZONE 'UTC', '%Y-%m-%d') || '-' ||
           CAST(hour(created_at AT TIME ZONE 'UTC') AS VARCHAR) AS bucket
    FROM gharchive_events WHERE created_at IS NOT NULL
""")
def hour_buckets_seen(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "gharchive_events").where("created_at is not null")
    return events.select(ev.hour_key(F.col("created_at")).alias("bucket")).distinct()


@query("""
    SELECT back, strftime(TIMESTAMP '2025-01-10 03:20:00' - to_hours(back), '%Y-%m-%d') || '-' ||
           CAST(hour(TIMESTAMP '2025-01-10 03:20:00' - to_hours(back)) AS VARCHAR) AS bucket
    FROM (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS back)
""")
def hour_buckets(spark: SparkSession, d: str) -> DataFrame:
    one = spark.range(1)
    return ev.hour_buckets(one, F.lit("2025-01-10 03:20:00").cast("timestamp"), ev.lookback_hours(F.lit(300)))


@query("SELECT c AS candidates, CAST(least(greatest(c // 50 + 1, 6), 12) AS BIGINT) AS hours FROM (VALUES (0), (250), (300), (5000)) t(c)")
def lookback_hours(spark: SparkSession, d: str) -> DataFrame:
    rows = values(spark, "(0), (250), (300), (5000)", "candidates")
    return rows.select("candidates", ev.lookback_hours(F.col("candidates")).alias("hours"))


_PAYLOAD = """
    SELECT id,
           coalesce(CASE WHEN event_payload ->> '$.action' = 'closed' AND
                         coalesce(CAST(event_payload ->> '$.pull_request.merged' AS BOOLEAN), false)
                    THEN 'merged' ELSE event_payload ->> '$.action' END, 'unknown') AS payload_action,
           coalesce(CAST(event_payload ->> '$.pull_request.number' AS BIGINT),
                    CAST(event_payload ->> '$.issue.number' AS BIGINT), 0) AS payload_number,
           coalesce(event_payload ->> '$.pull_request.base.sha', '') AS payload_sha,
           coalesce(CAST(event_payload ->> '$.repository.watchers_count' AS BIGINT), 0) AS payload_stars
    FROM gharchive_events
"""


@query(_PAYLOAD)
def event_normalize(spark: SparkSession, d: str) -> DataFrame:
    return ev.from_payload(table(spark, d, "gharchive_events"))


_LINES = r"""('{"type": "A", "id": 7, "repo": {"name": "o/r"}, "created_at": "2025-01-02T03:04:05Z"}'), ('{"type": "B"'), ('{"type": "C"} x'), ('not json'),
    ('{"id": "9"}'), ('{"type": "D", "org": null, "payload": {"action": "closed", "pull_request": {"merged": true, "number": 4}}}'),
    ('{"type": "E", "payload": {"issue": {"number": 12, "title": "T"}, "repository": {"watchers_count": 99999999999}}}'),
    ('{"type": "F", "payload": {"pull_request": {"body": "if (x) {} {y}", "base": {"sha": "b1"}, "merge_commit_sha": "m1", "head": {"repo": {"language": "Go"}}}}}'),
    ('{"type": "G", "actor": {"login": "x}y"}, "payload": {"issue": {"number": 3, "body": "} ] ,{"}}}'), ('{"type": "H"},{"type": "I"}'), ('{"type": "J"}}')"""
_PR, _IS = "$.payload.pull_request", "$.payload.issue"


@query(f"""
    SELECT e ->> '$.id' AS id, e ->> '$.type' AS event_type, coalesce(e ->> '$.repo.name', 'unknown/repo') AS repository,
           coalesce(e ->> '$.actor.login', 'unknown') AS actor,
           CASE WHEN e ->> '$.payload.action' = 'closed' AND coalesce(CAST(e ->> '{_PR}.merged' AS BOOLEAN), false)
                THEN 'merged' ELSE coalesce(e ->> '$.payload.action', 'unknown') END AS action,
           coalesce(CAST(e ->> '{_PR}.number' AS BIGINT), CAST(e ->> '{_IS}.number' AS BIGINT), 0) AS pull_number,
           CAST(e ->> '{_IS}.number' AS BIGINT) AS issue_number,
           coalesce(e ->> '{_PR}.base.sha', '') AS base_sha, coalesce(e ->> '{_PR}.merge_commit_sha', '') AS merge_sha,
           coalesce(e ->> '{_PR}.title', e ->> '{_IS}.title', 'Untitled change') AS title,
           coalesce(e ->> '{_PR}.body', e ->> '{_IS}.body', '') AS body, lower(e ->> '{_PR}.head.repo.language') AS language_hint,
           CASE WHEN CAST(e ->> '$.payload.repository.watchers_count' AS BIGINT) BETWEEN 0 AND 4294967295
                THEN CAST(e ->> '$.payload.repository.watchers_count' AS BIGINT) ELSE 0 END AS stars,
           list_contains(json_keys(e), 'org') AS has_org,
           CAST(replace(replace(e ->> '$.created_at', 'T', ' '), 'Z', '') AS TIMESTAMP) AS created_at
    FROM (SELECT CASE WHEN json_valid(v) THEN CAST(v AS JSON) END AS e FROM (VALUES {_LINES}) t(v))
    WHERE e ->> '$.type' IS NOT NULL
""")
def dump_lines(spark: SparkSession, d: str) -> DataFrame:
    events = ev.normalize_lines(values(spark, _LINES.replace("\\", "\\\\"), "value"))
    return events.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


_SEARCHES = "(20, 'rust', DATE '2025-01-05', 250), (0, CAST(NULL AS VARCHAR(9)), CAST(NULL AS DATE), 30), (5, 'go', CAST(NULL AS DATE), 100)"


@query(f"""
    SELECT q.*, concat_ws('+', 'type:pr', 'is:merged', CASE WHEN min_stars > 0 THEN 'stars:>=' || min_stars END,
                          'language:' || language, 'merged:>=' || strftime(merged_after, '%Y-%m-%d')) AS q,
           CAST(ceil(max_results / least(max_results, 100)) AS BIGINT) AS pages
    FROM (VALUES {_SEARCHES}) q(min_stars, language, merged_after, max_results)
""")
def search_query_text(spark: SparkSession, d: str) -> DataFrame:
    return ev.search_query(values(spark, _SEARCHES.replace("VARCHAR(9)", "STRING"), "min_stars, language, merged_after, max_results"))


@query("""
    SELECT doc_id, CASE WHEN len(string_split(url, '/')) >= 5
                        THEN concat_ws('/', string_split(url, '/')[4], string_split(url, '/')[5]) END AS url_repo
    FROM documents
""")
def url_to_repo(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", ev.repo_of_url(F.col("url")).alias("url_repo"))


@query("""
    SELECT instance_id AS id, repo, coalesce(difficulty_score, 1) AS difficulty_score,
           len(CAST(fail_to_pass AS VARCHAR[])) AS failing, len(CAST(pass_to_pass AS VARCHAR[])) AS passing,
           coalesce(hints_text, '') AS original_pr_body
    FROM (SELECT * REPLACE (coalesce(CASE WHEN json_valid(fail_to_pass) THEN from_json(fail_to_pass, '["VARCHAR"]') END, []) AS fail_to_pass,
                            coalesce(CASE WHEN json_valid(pass_to_pass) THEN from_json(pass_to_pass, '["VARCHAR"]') END, []) AS pass_to_pass)
          FROM dataset_rows)
    WHERE coalesce(instance_id, '') <> '' AND coalesce(repo, '') <> ''
""")
def dataset_scan(spark: SparkSession, d: str) -> DataFrame:
    done = tables.dataset_tasks(table(spark, d, "dataset_rows"))
    return done.select(
        "id", "repo", "difficulty_score", F.size("fail_to_pass").alias("failing"), F.size("pass_to_pass").alias("passing"),
        "original_pr_body",
    )


@query("""
    SELECT 'cache' AS origin, lower(trim(repo)) AS repo, pr_number AS number, CAST(NULL AS BIGINT) AS added_lines FROM pr_cache
    UNION ALL SELECT 'enriched', lower(trim(repository)), number, added_lines FROM enriched_prs
""")
def union_sources(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "pr_cache").select(F.lit("cache").alias("origin"), fold("repo").alias("repo"), F.col("pr_number").alias("number"))
    b = table(spark, d, "enriched_prs").select(F.lit("enriched").alias("origin"), fold("repository").alias("repo"), "number", "added_lines")
    return tables.union_all([a, b])


@query("""
    SELECT path, line_no, line FROM (
        SELECT CAST(doc_id AS VARCHAR) AS path, unnest(string_split(text, chr(10))) AS line,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents)
    WHERE regexp_matches(line, '^#+ .*[0-9]') ORDER BY path, line_no LIMIT 300
""")
def find_lines(spark: SparkSession, d: str) -> DataFrame:
    """Search with a limit, as the tool offers it."""
    files = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"))
    return tables.find_in_files(files, r"^#+ .*[0-9]", 300)


@query("""
    SELECT path, line_no, line FROM (
        SELECT CAST(doc_id AS VARCHAR) AS path, unnest(string_split(text, chr(10))) AS line,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents)
    WHERE line_no BETWEEN 3 AND 5
""")
def page_lines(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"))
    return tables.page_of(files, 2, 3)


# --------------------------------------------------------------------- filters
_BOT = "(actor LIKE '%[bot]%' OR actor = 'dependabot')"


@query(f"""
    SELECT id, repository, pull_number FROM gharchive_events
    WHERE lower(action) = 'merged' AND pull_number <> 0 AND NOT {_BOT} AND has_org
""")
def prefilter_chain(spark: SparkSession, d: str) -> DataFrame:
    return rules.candidates(table(spark, d, "gharchive_events")).select("id", "repository", "pull_number")


@query("""
    SELECT repository, number FROM enriched_prs
    WHERE title <> 'Untitled change' AND merge_sha <> '' AND files_changed > 0 AND (added_lines > 0 OR removed_lines > 0)
""")
def changed_code(spark: SparkSession, d: str) -> DataFrame:
    return rules.with_code_changes(table(spark, d, "enriched_prs")).select("repository", "number")


_BASE = "regexp_extract(lower(f), '([^/]*)$', 1)"
_TEST_PATH = rf"(regexp_matches({_BASE}, '{paths.TEST_NAMES}') OR regexp_matches(lower(f), '{paths.TEST_FOLDERS}'))"
_DOC_PATH = (
    f"(regexp_extract({_BASE}, '([^.]*)$', 1) IN ({', '.join(repr(x) for x in paths.DOC_EXTENSIONS)}) OR "
    + " OR ".join(f"starts_with({_BASE}, '{n}')" for n in paths.DOC_NAMES)
    + ")"
)


@query(f"SELECT DISTINCT f AS path, {_TEST_PATH} AS is_test, {_DOC_PATH} AS is_doc, regexp_matches(lower(f), '{paths.TEST_IN_PATCH}') AS is_patch_test "
       "FROM (SELECT unnest(changed_files) AS f FROM enriched_prs) WHERE f IS NOT NULL")  # fmt: skip
def path_kinds(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "enriched_prs").select(F.explode("changed_files").alias("path")).where("path is not null").distinct()
    p = F.col("path")
    return f.select(
        "path", paths.is_test(p).alias("is_test"), paths.is_doc(p).alias("is_doc"), paths.is_test_in_patch(p).alias("is_patch_test")
    )


@query(rf"""
    SELECT repository, number,
           len(fs) > 0 AND len(list_filter(fs, lambda f: NOT {_TEST_PATH})) = 0 AS tests_only,
           len(fs) > 0 AND len(list_filter(fs, lambda f: NOT {_DOC_PATH})) = 0 AS docs_only,
           len(list_filter(fs, lambda f: {_BASE} IN ({', '.join(repr(x) for x in paths.MANIFESTS)})
                                         OR regexp_matches(lower(f), '{paths.SOURCE_SUFFIXES}'))) > 0 AS has_build
    FROM (SELECT DISTINCT repository, number, coalesce(changed_files, []) AS fs FROM enriched_prs)
""")
def change_kinds(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "enriched_prs").select(
        "repository", "number", F.coalesce("changed_files", F.array().cast("array<string>")).alias("fs")
    ).distinct()
    fs = F.col("fs")
    return e.select(
        "repository", "number", paths.all_of(fs, paths.is_test).alias("tests_only"),
        paths.all_of(fs, paths.is_doc).alias("docs_only"), paths.has_build(fs).alias("has_build"),
    )


_BAD = ";|&$`(){}<>!\"\n\r\\"  # and the single quote, which needs doubling
_NAMES = ", ".join(
    f"('{x}')" for x in ["main", "-x", "a..b", "v1.0~2", "owner/name", ".a/b", "a/b/c", "src/a b.py", "/etc/x", "", "a''b", *(f"a{c}b" for c in _BAD)]
)


@query(rf"""
    SELECT v AS value,
           octet_length(encode(v)) <= 256 AND regexp_full_match(v, '[A-Za-z0-9/._~^][A-Za-z0-9/._~^-]*') AND NOT contains(v, '..') AS is_ref,
           octet_length(encode(v)) <= 256 AND regexp_full_match(v, '[A-Za-z0-9_][A-Za-z0-9._-]*/[A-Za-z0-9_][A-Za-z0-9._-]*') AS is_repo,
           v <> '' AND NOT regexp_matches(v, '[;|&$`(){{}}<>!"''\n\r\\]') AND NOT contains(v, '..') AND NOT starts_with(v, '/') AS is_path
    FROM (VALUES {_NAMES}) t(v)
""")
def ref_validators(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return values(spark, _NAMES.replace("\\", "\\\\"), "value").select(
        "value", paths.valid_ref(v).alias("is_ref"), paths.valid_repo(v).alias("is_repo"), paths.valid_path(v).alias("is_path")
    )


@query("""
    SELECT id FROM swe_tasks
    WHERE contains(lower(concat_ws(' ', language, repo, prompt, id)), 'rust') OR
          len(list_filter(map_values(meta), lambda x: contains(lower(x), 'rust'))) > 0
""")
def category_search(spark: SparkSession, d: str) -> DataFrame:
    own = F.lower(F.concat_ws(" ", "language", "repo", "prompt", "id")).contains("rust")
    meta = F.coalesce(F.exists(F.map_values("meta"), lambda x: F.lower(x).contains("rust")), F.lit(False))
    return table(spark, d, "swe_tasks").where(own | meta).select("id")


# ----------------------------------------------------------------------- joins
@query("""
    SELECT e.id, e.repository, e.pull_number FROM gharchive_events e
    WHERE NOT EXISTS (SELECT 1 FROM swe_tasks s WHERE lower(trim(s.repo)) = lower(trim(e.repository))
                      AND TRY_CAST(regexp_extract(s.id, '([0-9]+)$', 1) AS BIGINT) = e.pull_number)
""")
def skip_list_anti(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "swe_tasks").select(fold("repo").alias("r"), text.number_of_id(F.col("id")).alias("n")).distinct()
    e = table(spark, d, "gharchive_events").withColumn("r0", fold("repository"))
    return state.not_in(e, done, {"r0": "r", "pull_number": "n"}).select("id", "repository", "pull_number")


@query("""
    SELECT e.repository, e.number FROM enriched_prs e
    WHERE NOT EXISTS (SELECT 1 FROM pr_cache c WHERE c.status IN ('exported', 'rejected')
                      AND lower(trim(c.repo)) = lower(trim(e.repository)) AND c.pr_number = e.number)
""")
def cache_skip_anti(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "pr_cache").where("status in ('exported', 'rejected')").select(fold("repo").alias("r"), "pr_number")
    e = table(spark, d, "enriched_prs").withColumn("r0", fold("repository"))
    return state.not_in(e, known, {"r0": "r", "number": "pr_number"}).select("repository", "number")


@query("""
    SELECT lower(trim(e.repository)) AS repo, e.number, coalesce(c.triage_difficulty, 'medium') AS level,
           c.triage_difficulty IS NOT NULL AS reused
    FROM (SELECT DISTINCT lower(trim(repository)) AS repository, number FROM enriched_prs) e
    LEFT JOIN pr_cache c ON lower(trim(c.repo)) = e.repository AND c.pr_number = e.number
""")
def triage_reuse(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "enriched_prs").select(fold("repository").alias("repo"), "number").distinct()
    c = table(spark, d, "pr_cache").select(fold("repo").alias("repo"), F.col("pr_number").alias("number"), "triage_difficulty")
    return e.join(c, ["repo", "number"], "left").select(
        "repo", "number", F.coalesce("triage_difficulty", F.lit("medium")).alias("level"),
        F.col("triage_difficulty").isNotNull().alias("reused"),
    )


_FACTS = "SELECT lower(trim(repository)) AS repo, number AS pr_number, max(title) AS title, max(stars) AS stars, max(language) AS language FROM enriched_prs GROUP BY ALL"


@query(f"""
    SELECT c.row_id, coalesce(f.title, c.title) AS title, coalesce(f.stars, c.stars) AS stars, coalesce(f.language, c.language) AS language
    FROM pr_cache c LEFT JOIN ({_FACTS}) f ON f.repo = lower(trim(c.repo)) AND f.pr_number = c.pr_number
""")
def enrich_overlay(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "pr_cache").select("row_id", fold("repo").alias("repo"), "pr_number", "title", "stars", "language")
    f = table(spark, d, "enriched_prs").groupBy(fold("repository").alias("repo"), F.col("number").alias("pr_number")).agg(
        F.max("title").alias("title"), F.max("stars").alias("stars"), F.max("language").alias("language")
    )
    return state.overlay(c, f, ["repo", "pr_number"], ["title", "stars", "language"]).drop("repo", "pr_number")


# ------------------------------------------------------------------ aggregates
@query("SELECT coalesce(lower(trim(language)), 'unknown') AS language, coalesce(lower(trim(difficulty)), 'unknown') AS difficulty, count(*) AS n FROM dataset_rows GROUP BY ALL")
def dataset_stats(spark: SparkSession, d: str) -> DataFrame:
    return reports.counts_by(table(spark, d, "dataset_rows"), language=fold("language"), difficulty=fold("difficulty"))


@query("SELECT lower(trim(language)) AS value, count(*) AS n FROM dataset_rows GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def top_languages(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_counts(table(spark, d, "dataset_rows"), fold("language"), 10)


@query("SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in STATUSES) + " FROM pr_cache")
def status_histogram(spark: SparkSession, d: str) -> DataFrame:
    return state.status_histogram(table(spark, d, "pr_cache"), STATUSES)


_STEPS = {"merged": "lower(action) = 'merged'", "numbered": "pull_number <> 0", "human": f"NOT {_BOT}", "in_org": "has_org"}
_ALL = [" AND ".join(f"coalesce({x}, false)" for x in list(_STEPS.values())[: i + 1]) for i in range(len(_STEPS))]


@query(
    "SELECT *, " + ", ".join(f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST({n} AS DOUBLE) / {b} END AS {n}_rate" for n, b in zip(_STEPS, ["total", *_STEPS]))
    + " FROM (SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in zip(_STEPS, _ALL)) + " FROM gharchive_events)"
)
def funnel_metrics(spark: SparkSession, d: str) -> DataFrame:
    steps = {k: F.expr(v.replace("'%[bot]%'", "'%[bot]%'")) for k, v in _STEPS.items()}
    return reports.funnel(table(spark, d, "gharchive_events"), steps)


@query("""
    SELECT lower(string_split(trim(r), ' ')[1]) AS reason, count(*) AS n
    FROM (SELECT unnest(string_split(rejection_reason, ';')) AS r FROM pr_cache WHERE rejection_reason IS NOT NULL) GROUP BY ALL
""")
def rejection_histogram(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pr_cache").where("rejection_reason is not null")
    return reports.reason_histogram(rows, F.split("rejection_reason", ";"))


@query(r"""
    SELECT repo, pr_number, least(count(*), 100) AS files, CAST(sum(a) AS BIGINT) AS additions, CAST(sum(r) AS BIGINT) AS deletions,
           array_to_string(list_sort(list_distinct(list(f))), ' ') AS names
    FROM (SELECT repo, pr_number, regexp_extract(b, '^(\S+)', 1) AS f,
                 len(list_filter(string_split(b, chr(10)), lambda x: starts_with(x, '+') AND NOT starts_with(x, '+++'))) AS a,
                 len(list_filter(string_split(b, chr(10)), lambda x: starts_with(x, '-') AND NOT starts_with(x, '---'))) AS r
          FROM (SELECT lower(trim(repo)) AS repo, pr_number, unnest(string_split(chr(10) || patch, chr(10) || 'diff --git a/')[2:]) AS b FROM pr_cache WHERE patch IS NOT NULL))
    GROUP BY repo, pr_number
""")
def file_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Lines are counted in each file's own part of the diff."""
    c = table(spark, d, "pr_cache").where("patch is not null")
    b = c.select(fold("repo").alias("repo"), "pr_number", F.explode(text.diff_blocks(F.col("patch"))).alias("b"))
    lines = text.line_delta(F.col("b.text"))
    files = b.select("repo", "pr_number", F.col("b.path").alias("filename"), lines["added"].alias("additions"), lines["removed"].alias("deletions"))
    return reports.file_rollup(files, ["repo", "pr_number"]).withColumn("names", F.array_join("names", " "))


_RUN = """
    SELECT CAST(l_orderkey AS VARCHAR) AS task_id,
           CASE l_linenumber % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'after' ELSE 'agent' END AS phase,
           CASE WHEN l_linestatus = 'O' THEN 'f2p' ELSE 'p2p' END AS kind,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS exit_code,
           CASE WHEN l_quantity > 25 THEN 'Timeout' END AS stderr
    FROM lineitem
"""
_VERDICT = f"""
    SELECT task_id, CASE WHEN base = 0 THEN 'setup_error' WHEN insane > 0 THEN 'sanity_fail' WHEN stuck > 0 THEN 'agent_error'
                         WHEN tests > 0 AND passed = tests THEN 'resolved' ELSE 'unresolved' END AS status, passed, tests
    FROM (SELECT task_id, count(*) FILTER (phase = 'base') AS base,
                 count(*) FILTER (phase = 'base' AND ((kind = 'f2p' AND exit_code = 0) OR (kind = 'p2p' AND exit_code <> 0))) AS insane,
                 count(*) FILTER (phase = 'agent' AND exit_code <> 0 AND lower(coalesce(stderr, '')) LIKE '%timeout%') AS stuck,
                 count(*) FILTER (phase = 'after') AS tests, count(*) FILTER (phase = 'after' AND exit_code = 0) AS passed
          FROM ({_RUN}) GROUP BY task_id)
"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    q, m = F.col("l_quantity"), F.col("l_linenumber") % 3
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("task_id"),
        F.when(m == 0, "base").when(m == 1, "after").otherwise("agent").alias("phase"),
        F.when(F.col("l_linestatus") == "O", "f2p").otherwise("p2p").alias("kind"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("exit_code"),
        F.when(q > 25, "Timeout").alias("stderr"),
    )


@query(_VERDICT)
def harness_status(spark: SparkSession, d: str) -> DataFrame:
    return reports.run_status(_runs(spark, d))


@query(f"SELECT status, count(*) AS n, sum(passed) AS passed, sum(tests) AS tests FROM ({_VERDICT}) GROUP BY status")
def harness_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.run_status(_runs(spark, d)).groupBy("status").agg(
        F.count("*").alias("n"), F.sum("passed").alias("passed"), F.sum("tests").alias("tests")
    )


@query(f"""
    SELECT task_id, CASE WHEN max(CASE WHEN phase = 'base' AND kind = 'f2p' AND exit_code = 0 THEN 1 ELSE 0 END) = 1 THEN 'already passes'
                         WHEN max(CASE WHEN phase = 'base' AND kind = 'p2p' AND exit_code <> 0 THEN 1 ELSE 0 END) = 1 THEN 'breaks before'
                         WHEN max(CASE WHEN phase = 'after' AND exit_code <> 0 THEN 1 ELSE 0 END) = 1 THEN 'fails after'
                         ELSE 'passed' END AS outcome
    FROM ({_RUN}) GROUP BY task_id
""")
def workspace_outcome(spark: SparkSession, d: str) -> DataFrame:
    p, k, ok = F.col("phase"), F.col("kind"), F.col("exit_code") == 0
    rules = [
        ("already passes", (p == "base") & (k == "f2p") & ok),
        ("breaks before", (p == "base") & (k == "p2p") & ~ok),
        ("fails after", (p == "after") & ~ok),
    ]
    return reports.first_violation(_runs(spark, d), "task_id", rules, "passed")


_PROCESS = """
    SELECT run_id, commands, round(total_duration, 3) AS total_duration, short + late + slow + hits + missing AS issues,
           short + late + slow + hits + missing = 0 AS valid,
           round((2 - missing) / 2.0 * power(0.5, used) * power(0.9, greatest(short + late + slow + hits - used, 0)), 6) AS score
    FROM (SELECT user_id AS run_id, count(*) AS commands, sum(value) AS total_duration,
                 CASE WHEN count(*) < 5 THEN 1 ELSE 0 END AS short, CASE WHEN sum(value) > 900 THEN 1 ELSE 0 END AS late,
                 count(*) FILTER (value > 180) AS slow, count(*) FILTER (event_type = 'error') AS hits,
                 CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 1 ELSE 0 END AS used,
                 CASE WHEN count(*) FILTER (regexp_matches(event_type, '^cl')) = 0 THEN 1 ELSE 0 END +
                 CASE WHEN count(*) FILTER (regexp_matches(event_type, 'view$')) = 0 THEN 1 ELSE 0 END AS missing
          FROM events GROUP BY user_id)
"""


@query(_PROCESS)
def process_validation(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("command"), F.col("value").alias("duration"), F.lit(0).alias("exit_code")
    )
    out = reports.process_validation(runs, ["^cl", "view$"], ["error"], min_commands=5, max_single=180.0, max_total=900.0)
    return out.withColumns({"total_duration": F.round("total_duration", 3), "score": F.round("score", 6)})


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS period, sum(cents) OVER w AS spent, sum(cents) OVER w >= 500000 AS "over"
    FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events) WINDOW w AS (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def running_total(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    return reports.running_total(e, F.date_format("ts", "yyyy-MM-dd"), ["ts", "event_id"], cents, 500_000).select(
        "event_id", "period", "spent", "over"
    )


@query("""
    SELECT level, count(*) AS n, round(avg(CAST(quality_passed AS DOUBLE)), 6) AS success_rate, sum(ms) // count(*) AS mean_ms
    FROM (SELECT CASE WHEN m IN ('easy', 'medium', 'hard') THEN m ELSE 'medium' END AS level, quality_passed, len(prompt) AS ms
          FROM (SELECT *, meta['difficulty'] AS m FROM swe_tasks WHERE prompt IS NOT NULL)) GROUP BY level
""")
def difficulty_metrics(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "swe_tasks").where("prompt is not null")
    return reports.success_by_level(t, selection.LEVELS, F.col("meta")["difficulty"], F.col("quality_passed"), F.length("prompt")).withColumn(
        "success_rate", F.round("success_rate", 6)
    )


@query("""
    SELECT 'all' AS scope, count(*) AS tasks, count(*) FILTER (quality_passed) AS quality_passed,
           count(*) FILTER (docker_passed) AS docker_passed, sum(len(fail_to_pass) + len(pass_to_pass)) AS commands FROM swe_tasks
""")
def validate_summary(spark: SparkSession, d: str) -> DataFrame:
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    return table(spark, d, "swe_tasks").agg(
        F.lit("all").alias("scope"), F.count("*").alias("tasks"), F.count_if("quality_passed").alias("quality_passed"),
        F.count_if("docker_passed").alias("docker_passed"), F.sum(size("fail_to_pass") + size("pass_to_pass")).alias("commands"),
    )


@query("SELECT doc_id, CAST(ceil(octet_length(encode(text)) / 4.0) AS BIGINT) AS tokens FROM documents WHERE text IS NOT NULL")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select(
        "doc_id", F.ceil(F.octet_length("text") / 4).cast("bigint").alias("tokens")
    )


@query("""
    SELECT strftime(date_trunc('hour', created_at AT TIME ZONE 'UTC'), '%Y-%m-%d %H') AS hour, count(*) AS n,
           CAST(count(*) AS DOUBLE) / 3600 AS per_second, least(100.0, count(*) / 50.0 * 100) AS percent
    FROM gharchive_events WHERE created_at IS NOT NULL GROUP BY 1
""")
def progress_rates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "gharchive_events").where("created_at is not null")
    n = F.col("n").cast("double")
    return e.groupBy(F.date_format("created_at", "yyyy-MM-dd HH").alias("hour")).agg(F.count("*").alias("n")).select(
        "hour", "n", reports.ratio(n, F.lit(3600)).alias("per_second"), F.least(F.lit(100.0), n / 50 * 100).alias("percent")
    )


_FILES = "SELECT CAST(doc_id AS VARCHAR) AS task_id, 'text' AS target, text AS content FROM documents"
_CHECKS = (
    ("a", "exists", None), ("b", "contains", "the"), ("c", "not_contains", "Lorem"), ("d", "regex", "[0-9]{3}"), ("e", "line_count", "5"),
)
_CHECKED = (
    f"SELECT task_id, 'a' AS check_id, content IS NOT NULL AS passed, true AS required FROM ({_FILES}) "
    f"UNION ALL SELECT task_id, 'b', content IS NOT NULL AND contains(content, 'the'), true FROM ({_FILES}) "
    f"UNION ALL SELECT task_id, 'c', NOT contains(coalesce(content, ''), 'Lorem'), false FROM ({_FILES}) "
    f"UNION ALL SELECT task_id, 'd', content IS NOT NULL AND regexp_matches(content, '[0-9]{{3}}'), false FROM ({_FILES}) "
    f"UNION ALL SELECT task_id, 'e', content IS NOT NULL AND content <> '' AND len(string_split(regexp_replace(content, '\\n$', ''), chr(10))) >= 5, false FROM ({_FILES})"
)


def _checked(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    files = docs.select(F.col("doc_id").cast("string").alias("task_id"), F.lit("text").alias("path"), F.col("text").alias("content"))
    rules = F.array(
        *[
            F.struct(F.lit(i).alias("check_id"), F.lit(k).alias("kind"), F.lit(x).cast("string").alias("expected"), F.lit(i in "ab").alias("required"))
            for i, k, x in _CHECKS
        ]
    )
    checks = files.select("task_id", F.col("path").alias("target"), F.explode(rules).alias("r")).select("task_id", "target", "r.*")
    return reports.file_checks(files, checks)


@query(_CHECKED)
def verifier_checks(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d)


@query(f"SELECT task_id, bool_and(passed OR NOT required) AS passed, round(0.7 * avg(CAST(passed AS DOUBLE)), 6) AS score FROM ({_CHECKED}) GROUP BY task_id")
def verifier_score(spark: SparkSession, d: str) -> DataFrame:
    return reports.check_score(_checked(spark, d)).withColumn("score", F.round("score", 6))


# ------------------------------------------------------------ windows, top n
_QUOTA_CASE = "CASE triage_difficulty " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in QUOTAS.items()) + " ELSE 0 END"


@query(f"""
    SELECT row_id, triage_difficulty FROM (
        SELECT row_id, triage_difficulty, row_number() OVER (PARTITION BY triage_difficulty ORDER BY updated_at, row_id) AS rn FROM pr_cache)
    WHERE rn <= {_QUOTA_CASE}
""")
def quota_select(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pr_cache").select("row_id", "triage_difficulty", "updated_at")
    picked = selection.take_quotas(rows, QUOTAS, F.col("triage_difficulty"), [F.asc_nulls_last("updated_at"), "row_id"])
    return picked.select("row_id", "triage_difficulty")


@query(f"""
    SELECT q.level, q.quota, least(coalesce(c.n, 0), q.quota) AS taken, coalesce(c.n, 0) >= q.quota AS complete
    FROM (VALUES {', '.join(f"('{k}', {v})" for k, v in QUOTAS.items())}) q(level, quota)
    LEFT JOIN (SELECT triage_difficulty AS level, count(*) AS n FROM pr_cache WHERE status = 'exported' GROUP BY 1) c ON c.level = q.level
""")
def quota_progress(spark: SparkSession, d: str) -> DataFrame:
    return selection.quota_progress(table(spark, d, "pr_cache").where("status = 'exported'"), QUOTAS, F.col("triage_difficulty"))


@query("SELECT instance_id, (row_number() OVER (ORDER BY instance_id) - 1) // 50 AS shard FROM dataset_rows")
def shard_assign(spark: SparkSession, d: str) -> DataFrame:
    return selection.number_shards(table(spark, d, "dataset_rows").select("instance_id"), 50, ["instance_id"])


@query("SELECT row_id, list_extract(['a', 'b', 'c'], (row_number() OVER (ORDER BY pr_number, row_id) - 1) % 3 + 1) AS model FROM pr_cache WHERE pr_number IS NOT NULL")
def route_round_robin(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pr_cache").where("pr_number is not null").select("row_id", "pr_number")
    return selection.round_robin(rows, ["a", "b", "c"], ["pr_number", "row_id"]).select("row_id", "model")


@query("""
    SELECT row_id, CASE WHEN (row_number() OVER (PARTITION BY lower(trim(repo)) ORDER BY pr_number, row_id) - 1) % 100 < 30 THEN 'treatment' ELSE 'control' END AS arm
    FROM pr_cache WHERE pr_number IS NOT NULL
""")
def route_ab(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pr_cache").where("pr_number is not null").select("row_id", fold("repo").alias("r"), "pr_number")
    return selection.ab_arm(rows, 0.3, ["pr_number", "row_id"], ["r"]).select("row_id", "arm")


@query("SELECT doc_id, row_number() OVER (PARTITION BY coalesce(sha256(text), '') ORDER BY doc_id) > 1 AS hit FROM documents")
def cache_hits(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return state.first_seen(docs, F.coalesce(F.sha2("text", 256), F.lit("")), ["doc_id"]).select("doc_id", "hit")


@query("SELECT doc_id, sha256(text) AS digest FROM documents WHERE text IS NOT NULL")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("digest"))


# ------------------------------------------------------------------------ text
@query(r"""
    SELECT row_id, list_filter([TRY_CAST(regexp_extract(b, '(?i)fixes\s+#(\d+)', 1) AS BIGINT), TRY_CAST(regexp_extract(b, '(?i)close[s]?\s+#(\d+)', 1) AS BIGINT),
                                TRY_CAST(regexp_extract(b, '(?i)resolves\s+#(\d+)', 1) AS BIGINT)], lambda x: x IS NOT NULL) AS issues
    FROM (SELECT row_id, coalesce(body, '') AS b FROM pr_cache)
""")
def issue_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pr_cache").select("row_id", text.issue_links(F.col("body")).alias("issues"))


_BLOCKS = r"SELECT row_id, unnest(list_filter(string_split(chr(10) || patch, chr(10) || 'diff --git '), lambda x: starts_with(x, 'a/'))) AS b FROM pr_cache"
_SIDE = rf"regexp_matches(lower(regexp_extract(b, '^a/(\S+)', 1)), '{paths.TEST_IN_PATCH}')"


@query(f"""
    SELECT row_id, count(*) FILTER (NOT {_SIDE}) AS solution_blocks, count(*) FILTER ({_SIDE}) AS test_blocks
    FROM ({_BLOCKS}) GROUP BY row_id
""")
def diff_split(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "pr_cache").select("row_id", text.split_diff(F.col("patch")).alias("s"))
    n = lambda c: F.regexp_count(F.col(c), F.lit(r"(?m)^diff --git a/")).cast("bigint")
    return s.select("row_id", n("s.solution").alias("solution_blocks"), n("s.tests").alias("test_blocks")).where(
        "solution_blocks + test_blocks > 0"
    )


@query(r"""
    SELECT row_id, len(regexp_extract_all(patch, '(?m)^\+')) - len(regexp_extract_all(patch, '(?m)^\+\+\+')) AS added,
           len(regexp_extract_all(patch, '(?m)^-')) - len(regexp_extract_all(patch, '(?m)^---')) AS removed
    FROM pr_cache WHERE patch IS NOT NULL
""")
def line_delta(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pr_cache").where("patch is not null").select("row_id", text.line_delta(F.col("patch")).alias("x")).select("row_id", "x.*")


@query("SELECT id, coalesce(TRY_CAST(nullif(regexp_extract(id, '-([0-9]+)$', 1), '') AS BIGINT), 0) AS number FROM swe_tasks")
def id_to_number(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "swe_tasks").select("id", text.number_of_id(F.col("id")).alias("number"))


@query("""
    SELECT id, trim(replace(replace(replace(replace(replace(replace(replace(prompt, repo, ''), '/' || string_split(repo, '/')[-1], ''),
           '#' || n, ''), 'PR #' || n, ''), 'PR ' || n, ''), 'pull/' || n, ''), '  ', ' '), ' ' || chr(10) || chr(9) || chr(13)) AS stripped
    FROM (SELECT *, regexp_extract(id, '([0-9]+)$', 1) AS n FROM swe_tasks WHERE prompt IS NOT NULL)
""")
def strip_identifiers(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "swe_tasks").where("prompt is not null")
    return t.select("id", text.strip_identifiers(F.col("prompt"), F.col("repo"), text.number_of_id(F.col("id"))).alias("stripped"))


_COMMANDS = """('pytest tests/test_a.py tests/test_b.py'), ('python -m unittest pkg.mod.TestX'), ('npx jest src/*.test.js "a.test.ts"'),
    ('cd x && go test ./...'), ('bash run.sh;'), ('python3 -m unittest a.b tests/test_c.py')"""


@query(rf"""
    WITH c AS (SELECT v AS command, list_transform(regexp_split_to_array(trim(v), '\s+'), lambda t: regexp_replace(t, '^[''";]+|[''";]+$', '', 'g')) AS ts
               FROM (VALUES {_COMMANDS}) t(v)),
         n AS (SELECT *, list_filter(ts, lambda t: regexp_matches(t, '{text.TEST_SUFFIXES}') AND NOT regexp_matches(t, '[*?]')) AS named,
                      CASE WHEN regexp_matches(command, 'python3? -m unittest')
                           THEN list_transform(list_filter(ts, lambda t: contains(t, '.') AND NOT starts_with(t, '-') AND NOT contains(t, '/')),
                                               lambda t: replace(t, '.', '/') || '.py') ELSE [] END AS dotted FROM c)
    SELECT command, array_to_string(list_concat(named, list_filter(dotted, lambda x: NOT list_contains(named, x))), ' ') AS paths FROM n
""")
def command_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = values(spark, _COMMANDS, "command")
    return rows.select("command", F.array_join(text.command_paths(F.col("command")), " ").alias("paths"))


_HALF = "SELECT lower(trim(repository)) || '-' || number AS task_id, unnest(changed_files) AS path FROM enriched_prs WHERE number % 2 = 0"


@query(rf"""
    SELECT DISTINCT task_id, p AS ref FROM (
        SELECT lower(id) AS task_id, unnest(list_filter(regexp_split_to_array(trim(c), '\s+'), lambda x: regexp_matches(x, '{text.TEST_SUFFIXES}') AND NOT regexp_matches(x, '[*?]'))) AS p
        FROM (SELECT id, unnest(fail_to_pass) AS c FROM swe_tasks)) r
    WHERE NOT EXISTS (SELECT 1 FROM ({_HALF}) f WHERE f.task_id = r.task_id AND f.path IS NOT NULL
                      AND regexp_extract(f.path, '([^/]*)$', 1) = regexp_extract(r.p, '([^/]*)$', 1))
""")
def missing_references(spark: SparkSession, d: str) -> DataFrame:
    """The tests of every second task are there."""
    commands = table(spark, d, "swe_tasks").select(F.lower("id").alias("task_id"), F.explode("fail_to_pass").alias("command"))
    files = table(spark, d, "enriched_prs").where("number % 2 = 0").select(
        F.concat(fold("repository"), F.lit("-"), F.col("number").cast("string")).alias("task_id"), F.explode("changed_files").alias("path")
    )
    return tasks.unknown_references(commands, files.where("path is not null"))


@query("""
    SELECT row_id, title AS whole, CASE WHEN strlen(title) <= 24 THEN title ELSE
        (SELECT max(substr(title, 1, n)) FROM (SELECT unnest(range(0, 25)) AS n) WHERE strlen(substr(title, 1, n)) <= 24) || '...' END AS cut
    FROM pr_cache WHERE title IS NOT NULL
""")
def byte_truncate(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "pr_cache").where("title is not null")
    return t.select("row_id", F.col("title").alias("whole"), text.truncate_bytes(F.col("title"), 24, "...").alias("cut"))


_ANSWERS = (
    "('{\"a\": 1}'), ('Sure: {\"n\": \"x\", \"c\": 5} - done'), ('x [1, 2, 3] y'), ('```json\n{\"k\": {\"v\": \"}\"}}\n```'),"
    " ('{\"cut\": [1, 2'), ('none at all'), ('first {\"a\": 1} then {\"b\": {\"c\": 2}}'), ('')"
)


@query(r"""
    SELECT * FROM (VALUES ('{"a": 1}', 'success', '{"a": 1}', 0, 0), ('Sure: {"n": "x", "c": 5} - done', 'success', '{"n": "x", "c": 5}', 0, 0), ('x [1, 2, 3] y', 'success', '[1, 2, 3]', 0, 0),
        ('```json' || chr(10) || '{"k": {"v": "}"}}' || chr(10) || '```', 'success', '{"k": {"v": "}"}}', 0, 0), ('{"cut": [1, 2', 'truncated', '{"cut": [1, 2', 1, 1),
        ('none at all', 'not_found', NULL, 0, 0), ('first {"a": 1} then {"b": {"c": 2}}', 'success', '{"b": {"c": 2}}', 0, 0), ('', 'not_found', NULL, 0, 0)) t(answer, status, json, braces, brackets)
""")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    rows = values(spark, _ANSWERS.replace("\\", "\\\\"), "answer")
    return rows.select("answer", jsonx.recovered(F.col("answer")).alias("x")).select("answer", "x.*")


_KINDS = "id, batch_id, event_payload AS p, len(event_payload) % 4 AS kind"


@query(f"""
    SELECT id, batch_id, CASE WHEN kind = 3 THEN 'truncated' ELSE 'success' END AS status, CASE WHEN kind = 3 THEN left(p, len(p) - 1) ELSE p END AS json,
           CASE WHEN kind = 3 THEN 1 ELSE 0 END AS braces
    FROM (SELECT {_KINDS} FROM gharchive_events WHERE event_payload IS NOT NULL)
""")
def json_extract_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Payloads in running text, in a fence, beside a smaller object, and without their last brace."""
    p, kind = F.col("event_payload"), F.length("event_payload") % 4
    text_ = (
        F.when(kind == 0, F.concat(F.lit("The event was "), p, F.lit(" as received.")))
        .when(kind == 1, F.concat(F.lit("```json\n"), p, F.lit("\n``` it was")))
        .when(kind == 2, F.concat(F.lit('not {"a": 1} but '), p))
        .otherwise(F.left(p, F.length(p) - 1))
    )
    e = table(spark, d, "gharchive_events").where("event_payload is not null")
    return e.select("id", "batch_id", jsonx.recovered(text_).alias("x")).select("id", "batch_id", "x.status", "x.json", F.col("x.braces").cast("int").alias("braces"))


# ------------------------------------------------------------------- integrity
_UUID = """
    SELECT id, 'CANARY-' || upper(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
               substr('89ab', 1 + ((instr('0123456789abcdef', substr(h, 17, 1)) - 1) & 3), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)) AS canary
    FROM (SELECT id, sha1(unhex('6ba7b8129dad11d180b400c04fd430c8') || encode(id || '-2a00000000000000')) AS h FROM swe_tasks)
"""


@query(f"SELECT id, canary, sha256(canary) AS digest FROM ({_UUID})")
def canary_ids(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "swe_tasks").select("id", integrity.canary_id(F.col("id"), 42).alias("canary"))
    return t.select("id", "canary", integrity.canary_hash(F.col("canary")).alias("digest"))


@query(f"""
    SELECT id, exact OR sure > 0.8 AS contaminated, exact AS canary_found, part AS partial_match, sure AS confidence
    FROM (SELECT *, CASE WHEN exact THEN 1.0 WHEN part THEN 0.6 ELSE 0.0 END AS sure
          FROM (SELECT id, contains(o, canary) AS exact, len(list_filter(string_split(substr(canary, 8), '-'), lambda p: contains(o, p))) > 0 AS part
                FROM (SELECT u.id, u.canary, upper(CASE WHEN hash_n % 3 = 0 THEN t.prompt || u.canary
                                                        WHEN hash_n % 3 = 1 THEN t.prompt || substr(u.canary, 8, 8) ELSE t.prompt END) AS o
                      FROM ({_UUID}) u JOIN (SELECT id, prompt, coalesce(difficulty_score, 0) AS hash_n FROM swe_tasks WHERE prompt IS NOT NULL) t USING (id))))
""")
def contamination_scan(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "swe_tasks").where("prompt is not null").withColumn("canary", integrity.canary_id(F.col("id"), 42))
    n = F.coalesce("difficulty_score", F.lit(0)) % 3
    out = F.when(n == 0, F.concat("prompt", "canary")).when(n == 1, F.concat("prompt", F.substring("canary", 8, 8))).otherwise(F.col("prompt"))
    return t.select("id", integrity.contamination(out, F.col("canary")).alias("x")).select("id", "x.*")


@query("SELECT id, true AS same FROM swe_tasks")
def seal_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    key = "quarry-7"
    t = table(spark, d, "swe_tasks").select("id", integrity.seal(F.col("id"), key).alias("s"))
    return t.select("id", (integrity.unseal(F.col("s"), key) == F.col("id")).alias("same"))


# ---------------------------------------------------------------- keyed state


@query("""
    SELECT user_id, arg_max(event_type, event_id) AS status, arg_max(value, event_id) FILTER (value > 50) AS value,
           min(event_id) AS first_seq, max(event_id) AS last_seq FROM events GROUP BY user_id
""")
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "events").select("user_id", "event_id", F.col("event_type").alias("status"), F.when(F.col("value") > 50, F.col("value")).alias("value"))
    return state.merge_log(log, ["user_id"], "event_id")


@query("""
    SELECT c.row_id, CASE WHEN t.number IS NOT NULL THEN 'exported' ELSE c.status END AS status, c.rejection_reason
    FROM pr_cache c LEFT JOIN (SELECT DISTINCT lower(trim(repo)) AS repo, TRY_CAST(regexp_extract(id, '([0-9]+)$', 1) AS BIGINT) AS number
                               FROM swe_tasks WHERE docker_passed) t ON t.repo = lower(trim(c.repo)) AND t.number = c.pr_number
""")
def mark_exported(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "pr_cache").select("row_id", fold("repo").alias("repo"), "pr_number", "status", "rejection_reason")
    t = table(spark, d, "swe_tasks").where("docker_passed").select(fold("repo").alias("repo"), text.number_of_id(F.col("id")).alias("pr_number"))
    return state.mark(c, t, ["repo", "pr_number"], "exported").select("row_id", "status", "rejection_reason")


# --------------------------------------------------------------------- export
@query("""
    SELECT id AS instance_id, repo, base_commit, patch, nullif(test_patch, '') AS test_patch, prompt AS problem_statement,
           nullif(original_pr_body, '') AS hints_text, strftime(created_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS created_at,
           nullif(meta['version'], '') AS version, to_json(fail_to_pass)::VARCHAR AS fail_to_pass, to_json(pass_to_pass)::VARCHAR AS pass_to_pass,
           nullif(meta['environment_setup_commit'], '') AS environment_setup_commit, language,
           coalesce(meta['difficulty'], CASE WHEN difficulty_score <= 1 THEN 'easy' WHEN difficulty_score = 2 THEN 'medium' ELSE 'hard' END) AS difficulty,
           difficulty_score, CASE WHEN NOT isnan(quality_score) THEN quality_score END AS quality_score
    FROM swe_tasks
""")
def export_projection(spark: SparkSession, d: str) -> DataFrame:
    return dataset.export_projection(table(spark, d, "swe_tasks"))


@query("""
    WITH t AS (SELECT id, '# ' || id || chr(10) || chr(10) || coalesce(prompt, '') || chr(10) AS p,
                      CASE WHEN coalesce(original_pr_body, '') <> '' THEN '# ' || id || ' (original PR)' || chr(10) || chr(10) || original_pr_body || chr(10) END AS o,
                      CASE WHEN len(fail_to_pass) > 0 THEN array_to_string(list_concat(fail_to_pass, coalesce(pass_to_pass, [])), chr(10)) END AS c,
                      fail_to_pass AS f, pass_to_pass AS g, from_json(meta['test_files'], '[{"path":"VARCHAR","content":"VARCHAR"}]') AS tests
               FROM swe_tasks),
         files AS (
            SELECT id, 'prompt.md' AS path, p AS content FROM t
            UNION ALL SELECT id, 'original_pr.md', o FROM t WHERE o IS NOT NULL
            UNION ALL SELECT id, 'checks.txt', c FROM t WHERE c IS NOT NULL
            UNION ALL SELECT id, 'tests/fail_to_pass_' || i || '.sh', '#!/bin/bash' || chr(10) || '# This test must FAIL on base commit, PASS after fix' || chr(10) || f[i] || chr(10)
                      FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM t)
            UNION ALL SELECT id, 'tests/pass_to_pass_' || i || '.sh', '#!/bin/bash' || chr(10) || '# This test must PASS on base commit AND after fix' || chr(10) || g[i] || chr(10)
                      FROM (SELECT *, unnest(range(1, len(g) + 1)) AS i FROM t)
            UNION ALL SELECT id, 'tests/' || CASE WHEN row_number() OVER (PARTITION BY id, b ORDER BY i) = 1 THEN b ELSE (i - 1) || '_' || b END, content
                      FROM (SELECT id, i, regexp_extract(tests[i].path, '([^/]*)$', 1) AS b, tests[i].content AS content
                            FROM (SELECT *, unnest(range(1, len(tests) + 1)) AS i FROM t)))
    SELECT id AS task_id, path, md5(content) AS digest FROM files WHERE content IS NOT NULL
""")
def task_files(spark: SparkSession, d: str) -> DataFrame:
    made = dataset.task_files(table(spark, d, "swe_tasks")).where("path != 'workspace.yaml'")
    return made.select("task_id", "path", F.md5(F.encode("content", "UTF-8")).alias("digest"))


@query("SELECT '{\"repo\":\"' || repo || '\",\"pr\":' || regexp_extract(id, '([0-9]+)$', 1) || '}' AS value FROM swe_tasks")
def processed_lines(spark: SparkSession, d: str) -> DataFrame:
    return dataset.processed_lines(table(spark, d, "swe_tasks"))


@query("""
    SELECT repository, number, pos, CASE WHEN rn = 1 THEN b ELSE pos || '_' || b END AS name FROM (
        SELECT *, row_number() OVER (PARTITION BY repository, number, b ORDER BY pos) AS rn FROM (
            SELECT repository, number, CAST(i - 1 AS INTEGER) AS pos, regexp_extract(changed_files[i], '([^/]*)$', 1) AS b
            FROM (SELECT *, unnest(range(1, len(changed_files) + 1)) AS i FROM (SELECT DISTINCT repository, number, changed_files FROM enriched_prs))))
""")
def basename_dedup(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "enriched_prs").select("repository", "number", "changed_files").distinct()
    f = e.select("repository", "number", F.posexplode("changed_files").alias("pos", "path"), F.concat_ws("\x1f", "repository", "number").alias("task_id"))
    return selection.dedupe_basenames(f).select("repository", "number", "pos", "name")


@query("""
    SELECT sum(n) AS total, CAST(ceil(sum(n) / 50.0) AS BIGINT) AS shards, string_agg(k || '=' || n, ',' ORDER BY k) AS by_difficulty
    FROM (SELECT coalesce(difficulty, 'unknown') AS k, count(*) AS n FROM dataset_rows GROUP BY 1)
""")
def dataset_summary(spark: SparkSession, d: str) -> DataFrame:
    levels = F.transform(F.array_sort(F.map_entries("by_difficulty")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return dataset.summary(table(spark, d, "dataset_rows")).withColumn("by_difficulty", F.array_join(levels, ","))


@query("""
    SELECT date_trunc('hour', created_at AT TIME ZONE 'UTC') AS hour, event_type, count(*) AS n
    FROM gharchive_events WHERE created_at IS NOT NULL GROUP BY ALL
""")
def hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    """The batch form of the streaming job; both are compared in the tests."""
    e = table(spark, d, "gharchive_events").where("created_at is not null")
    hour = F.window("created_at", "1 hour")["start"].cast("timestamp_ntz")
    return e.groupBy(hour.alias("hour"), "event_type").agg(F.count("*").alias("n"))


# ----------------------------------------------------------------------- tasks
@query("""
    SELECT row_id, repo || ' (#' || pr_number || '): ' || title || chr(10) || chr(10) ||
           CASE WHEN coalesce(body, '') = '' THEN '(no description)' ELSE body END AS whole FROM pr_cache
""")
def original_text(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "pr_cache")
    whole = tasks.original_text(F.col("repo"), F.col("pr_number"), F.col("title"), F.col("body"))
    return c.select("row_id", whole.alias("whole"))


@query("""
    SELECT id, CASE WHEN p = '' THEN 'empty' WHEN strlen(p) < 100 THEN 'short'
                    WHEN len(list_filter(fail_to_pass, lambda c: contains(lower(p), lower(trim(c))))) > 0 THEN 'names a command'
                    WHEN len(list_filter(fail_to_pass, lambda c: contains(lower(p), lower(regexp_extract(c, '([^/]*)$', 1))))) > 0 THEN 'names a file' END AS reason
    FROM (SELECT id, fail_to_pass, trim(coalesce(prompt, ''), ' ' || chr(10) || chr(9) || chr(13)) AS p FROM swe_tasks)
""")
def prompt_feasibility(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "swe_tasks")
    return t.select("id", tasks.feasibility(F.col("prompt"), F.col("fail_to_pass"), F.col("fail_to_pass")).alias("reason"))


_TESTS = (
    "('import x\nassert 1\nassert 2\nopen(p).read()'), ('assert \"a\" in source'), ('import a\nexpect(x)\nexpect(y)\nexpect(z)\nreadFile(p)'),"
    " ('assert open(f).read()'), ('no assertion readFile(x)')"
)
_WAYS = [p.replace("'", "''") for p in tasks.SOURCE_READING]


@query(
    "SELECT v AS content, "
    + " + ".join(
        f"CASE WHEN len(regexp_extract_all(v, '{w}')) > 0 AND a > 0 AND (len(regexp_extract_all(v, '{w}')) * 2 > a OR NOT b) THEN 1 ELSE 0 END" for w in _WAYS
    )
    + f""" AS ways FROM (SELECT v, len(regexp_extract_all(v, 'assert|expect\\(|Assert\\.')) AS a,
           contains(v, 'import ') OR contains(v, 'require(') OR contains(v, 'from ') OR contains(v, 'fetch(') OR contains(v, 'request(') AS b
           FROM (VALUES {_TESTS}) t(v))"""
)
def source_reading_tests(spark: SparkSession, d: str) -> DataFrame:
    return values(spark, _TESTS, "content").select("content", tasks.reads_sources(F.col("content")).alias("ways"))


@query("""
    SELECT DISTINCT lower(trim(repository)) || '-' || number AS task_id, f AS path
    FROM (SELECT repository, number, unnest(changed_files) AS f FROM enriched_prs)
    WHERE f IS NOT NULL AND NOT starts_with(regexp_extract(f, '([^/]*)$', 1), '.')
      AND NOT EXISTS (SELECT 1 FROM (SELECT lower(id) AS t, unnest(fail_to_pass) AS c FROM swe_tasks) g
                      WHERE g.t = lower(trim(repository)) || '-' || number AND split_part(g.c, ' ', 2) = f)
""")
def created_files(spark: SparkSession, d: str) -> DataFrame:
    made = table(spark, d, "enriched_prs").select(
        F.concat(fold("repository"), F.lit("-"), F.col("number").cast("string")).alias("task_id"), F.explode("changed_files").alias("path")
    ).where("path is not null")
    given = table(spark, d, "swe_tasks").select(F.lower("id").alias("task_id"), F.explode("fail_to_pass").alias("c"))
    return tasks.created_files(made, given.select("task_id", F.split_part("c", F.lit(" "), F.lit(2)).alias("path")))


@query("""
    SELECT o_orderkey AS k, score, CASE WHEN score < 0.34 THEN 'easy' WHEN score < 0.67 THEN 'medium' ELSE 'hard' END AS level
    FROM (SELECT o_orderkey, greatest(0.0, least(1.0, 0.4 * least(o_totalprice / 100 / 3600.0, 1.0) +
                 0.4 * (1.0 - greatest(0.0, least(1.0, (o_custkey % 11) / 10.0))) + 0.2 * least((o_orderkey % 7) / 5.0, 1.0))) AS score FROM orders)
""")
def difficulty_score(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    s = tasks.difficulty_score(F.col("o_totalprice") / 100, (F.col("o_custkey") % 11) / 10.0, (F.col("o_orderkey") % 7).cast("double"))
    return o.select(F.col("o_orderkey").alias("k"), s.alias("score"), tasks.level_of(s).alias("level"))


@query("""
    SELECT event_id, user_id, row_number() OVER w AS step, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6 AS since
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def number_steps(spark: SparkSession, d: str) -> DataFrame:
    return tasks.number_steps(table(spark, d, "events"), "user_id", ["ts", "event_id"]).select("event_id", "user_id", "step", "since")


@query("""
    SELECT l_orderkey AS run, count(*) AS steps, sum(l_quantity) AS duration, sum(l_linenumber + l_partkey) AS tokens FROM lineitem GROUP BY 1
""")
def trace_totals(spark: SparkSession, d: str) -> DataFrame:
    steps = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("run"), F.col("l_quantity").alias("duration"), F.col("l_linenumber").alias("tokens_in"), F.col("l_partkey").alias("tokens_out")
    )
    return tasks.trace_totals(steps, "run")


_OFFERS = "('small', 200, 1), ('mid', 800, 3), ('wide', 800, 2), ('huge', 4000, 9)"


@query(f"""
    SELECT d.doc_id AS request_id, (SELECT arg_min(o.name, o.cost) FROM (VALUES {_OFFERS}) o(name, room, cost) WHERE o.room >= d.n_chars) AS name
    FROM documents d WHERE d.n_chars IS NOT NULL
""")
def route_cheapest(spark: SparkSession, d: str) -> DataFrame:
    offers = values(spark, _OFFERS, "name, room, cost")
    need = table(spark, d, "documents").where("n_chars is not null").select(F.col("doc_id").alias("request_id"), "n_chars")
    return tasks.best_offer(need, offers, "n_chars", "room", ["cost"])


@query("""
    SELECT CASE WHEN l = '' THEN 'OTHER' ELSE l END AS level, count(*) AS n
    FROM (SELECT regexp_extract(line, '\\b(ERROR|WARN|INFO|DEBUG|TRACE)\\b', 1) AS l
          FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)) GROUP BY 1
""")
def log_levels(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return tasks.log_levels(lines)


@query("""
    WITH j AS (SELECT l_orderkey AS task_id, l_linenumber AS attempt,
                      CASE WHEN l_returnflag = 'R' THEN 'no failing test' WHEN l_discount > 0.08 THEN 'no install' WHEN l_tax > 0.06 THEN 'breaks' END AS f,
                      CASE WHEN l_returnflag = 'R' THEN 'no failing test' WHEN l_tax > 0.06 THEN 'breaks' END AS h
               FROM (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS l_returnflag, max(l_discount) AS l_discount, max(l_tax) AS l_tax FROM lineitem GROUP BY 1, 2)),
         n AS (SELECT *, count(f) OVER (PARTITION BY task_id ORDER BY attempt ROWS UNBOUNDED PRECEDING) AS c FROM j)
    SELECT task_id, attempt, CASE WHEN f IS NULL THEN 'accepted' WHEN c <= 2 THEN 'retry' WHEN h IS NOT NULL THEN 'refused' ELSE 'accepted' END AS decision,
           CASE WHEN f IS NULL THEN NULL WHEN c <= 2 THEN f WHEN h IS NOT NULL THEN h END AS reason FROM n
""")
def submission_decision(spark: SparkSession, d: str) -> DataFrame:
    keys = F.col("l_orderkey").alias("task_id"), F.col("l_linenumber").alias("attempt")
    rows = table(spark, d, "lineitem").groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("l_returnflag", "l_discount", "l_tax")])
    rules = [
        ("no failing test", F.col("l_returnflag") == "R", True),
        ("no install", F.col("l_discount") > 0.08, False),
        ("breaks", F.col("l_tax") > 0.06, True),
    ]
    return tasks.submission(rows, rules, retries=2)


_REPLIES = "('{\"a\": 1}', 'x', 'r'), (' ', 'hello', 'r'), (CAST(NULL AS VARCHAR(9)), '', 'because'), ('', ' ', '')"


@query(f"""
    SELECT a, c, r, coalesce(CASE WHEN trim(a) <> '' THEN a END, CASE WHEN trim(c) <> '' THEN c END, CASE WHEN trim(r) <> '' THEN r END) AS chosen
    FROM (VALUES {_REPLIES}) t(a, c, r)
""")
def message_select(spark: SparkSession, d: str) -> DataFrame:
    rows = values(spark, _REPLIES.replace("VARCHAR(9)", "STRING"), "a, c, r")
    return rows.select("a", "c", "r", tasks.select_message(F.col("a"), F.col("c"), F.col("r")).alias("chosen"))


@query("""
    SELECT id, translate(id, '/ ', '-_') AS name, '''' || replace(repo, '''', '''\\''''') || '''' AS quoted,
           CASE WHEN len(base_commit) <= 8 THEN repeat('*', len(base_commit)) ELSE base_commit[:4] || '...' || base_commit[-4:] END AS masked FROM swe_tasks
""")
def task_names(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "swe_tasks")
    return t.select("id", tasks.safe_name(F.col("id")).alias("name"), tasks.shell_quote(F.col("repo")).alias("quoted"), tasks.mask(F.col("base_commit")).alias("masked"))


@query("SELECT row_id, CASE WHEN merge_sha <> '' THEN merge_sha END AS merge_sha, actor FROM pr_cache")
def provenance(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "pr_cache")
    m = tasks.provenance(merge_sha=F.when(F.col("merge_sha") != "", F.col("merge_sha")), actor=F.col("actor"))
    return c.select("row_id", m.alias("m")).select("row_id", F.col("m")["merge_sha"].alias("merge_sha"), F.col("m")["actor"].alias("actor"))
