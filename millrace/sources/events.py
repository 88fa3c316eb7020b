"""Event dumps: which hours to read, reading them, and normalising their payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.runtime import exists


def hour_key(ts: Column) -> Column:
    """``yyyy-MM-dd-H``, the hour without padding."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("-"), F.hour(ts).cast("string"))


def lookback_hours(candidates: Column) -> Column:
    """How many hours back to read for so many candidates: 6 to 12."""
    return F.least(F.greatest(F.floor(candidates / 50) + 1, F.lit(6)), F.lit(12)).cast("bigint")


def hour_buckets(rows: DataFrame, now: Column, hours: Column) -> DataFrame:
    """One row per hour before ``now`` (its own excluded), latest first, with its ``bucket`` key."""
    back = F.explode(F.sequence(F.lit(1), F.greatest(hours.cast("int"), F.lit(1)))).alias("back")
    return rows.select(now.alias("now"), back).select(
        "back", hour_key(F.col("now") - F.make_dt_interval(hours=F.col("back"))).alias("bucket")
    )


def read_dumps(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of hourly dumps (``.json.gz``); missing and damaged files count as empty.

    A gzip file is one task; the rows are dealt anew so that parsing uses all slots.
    """
    lines = (
        spark.read.option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True).text(list(paths)).where("value != ''")
    )
    return lines.repartition(max(len(paths), spark.sparkContext.defaultParallelism))


def read_hours(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Events of the hours ``root/key.json.gz`` that there are; it is an error if none of them has a line."""
    paths = [f"{root.rstrip('/')}/{k}.json.gz" for k in keys]
    lines = read_dumps(spark, [p for p in paths if exists(spark, p)]) if any(exists(spark, p) for p in paths) else None
    if lines is None or lines.isEmpty():
        raise ValueError(f"no events in {len(paths)} hours")
    return normalize_lines(lines)


def _wrapped(line: Column, before: str, after: str) -> Column:
    return F.try_parse_json(F.concat(F.lit(before), line, F.lit(after)))


def valid_object(line: Column) -> Column:
    """Whether a line is one whole JSON object.

    The lenient parser stops behind the first value, so the line must parse
    inside a list, as its only item, and inside an object: whatever is behind
    it would end one of the two too early, but never both.
    """
    items = F.try_variant_get(_wrapped(line, "[", "]"), "$", "array<variant>")
    return F.coalesce(
        F.trim(line).startswith("{") & (F.size(items) == 1) & _wrapped(line, '{"v":', "}").isNotNull(), F.lit(False)
    )


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def normalize_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Dump lines as events with all defaults filled in; lines that are no event are dropped.

    The id is kept as text whatever its type; ``created_at`` is the time of the
    event. Stars outside 32 bits become 0.
    """
    v = F.try_parse_json(F.col(value))
    e = lines.where(valid_object(F.col(value))).select(F.col(value).alias("line"), v.alias("v"))
    col = F.col("v")
    merged = (_get(col, "$.payload.action", "string") == "closed") & F.coalesce(
        _get(col, "$.payload.pull_request.merged", "boolean"), F.lit(False)
    )
    stars = _get(col, "$.payload.repository.watchers_count", "bigint")
    return e.select(
        _get(col, "$.id", "string").alias("id"),
        _get(col, "$.type", "string").alias("event_type"),
        F.coalesce(_get(col, "$.repo.name", "string"), F.lit("unknown/repo")).alias("repository"),
        F.coalesce(_get(col, "$.actor.login", "string"), F.lit("unknown")).alias("actor"),
        F.when(merged, "merged")
        .otherwise(F.coalesce(_get(col, "$.payload.action", "string"), F.lit("unknown")))
        .alias("action"),
        F.coalesce(
            _get(col, "$.payload.pull_request.number", "bigint"), _get(col, "$.payload.issue.number", "bigint"), F.lit(0)
        ).alias("pull_number"),
        _get(col, "$.payload.issue.number", "bigint").alias("issue_number"),
        F.coalesce(_get(col, "$.payload.pull_request.base.sha", "string"), F.lit("")).alias("base_sha"),
        F.coalesce(_get(col, "$.payload.pull_request.merge_commit_sha", "string"), F.lit("")).alias("merge_sha"),
        F.coalesce(
            _get(col, "$.payload.pull_request.title", "string"),
            _get(col, "$.payload.issue.title", "string"),
            F.lit("Untitled change"),
        ).alias("title"),
        F.coalesce(
            _get(col, "$.payload.pull_request.body", "string"), _get(col, "$.payload.issue.body", "string"), F.lit("")
        ).alias("body"),
        F.lower(_get(col, "$.payload.pull_request.head.repo.language", "string")).alias("language_hint"),
        F.when(stars.between(0, (1 << 32) - 1), stars).otherwise(F.lit(0)).alias("stars"),
        F.coalesce(F.array_contains(F.json_object_keys("line"), "org"), F.lit(False)).alias("has_org"),
        _get(col, "$.created_at", "string").try_cast("timestamp").alias("created_at"),
    ).where("event_type is not null")


def from_payload(events: DataFrame) -> DataFrame:
    """Re-derive action, number, commit and stars from the stored payload of events."""
    v = F.try_parse_json("event_payload")
    number = F.coalesce(_get(v, "$.pull_request.number", "bigint"), _get(v, "$.issue.number", "bigint"), F.lit(0))
    raw = _get(v, "$.action", "string")
    merged = (raw == "closed") & F.coalesce(_get(v, "$.pull_request.merged", "boolean"), F.lit(False))
    return events.select(
        "id",
        F.coalesce(F.when(merged, "merged").otherwise(raw), F.lit("unknown")).alias("payload_action"),
        number.alias("payload_number"),
        F.coalesce(_get(v, "$.pull_request.base.sha", "string"), F.lit("")).alias("payload_sha"),
        F.coalesce(_get(v, "$.repository.watchers_count", "bigint"), F.lit(0)).alias("payload_stars"),
    )


def search_query(config: DataFrame) -> DataFrame:
    """Search text of a configuration: stars, language and date are optional parts joined by ``+``."""
    return config.select(
        "*",
        F.concat_ws(
            "+",
            F.lit("type:pr"),
            F.lit("is:merged"),
            F.when(F.col("min_stars") > 0, F.concat(F.lit("stars:>="), F.col("min_stars").cast("string"))),
            F.concat(F.lit("language:"), F.col("language")),
            F.concat(F.lit("merged:>="), F.date_format("merged_after", "yyyy-MM-dd")),
        ).alias("q"),
        F.ceil(F.col("max_results") / F.least("max_results", F.lit(100))).cast("bigint").alias("pages"),
    )


def search_pages(config: DataFrame, per_page: int = 100) -> DataFrame:
    """The pages of each search: its columns, ``page`` from 1 and ``per_page``, at most as many rows as are wanted."""
    size = F.least("max_results", F.lit(per_page))
    pages = F.sequence(F.lit(1), F.greatest(F.ceil(F.col("max_results") / size).cast("int"), F.lit(1)))
    return config.where("max_results > 0").select("*", F.explode(pages).alias("page"), size.cast("int").alias("per_page"))


def kept_pages(fetched: DataFrame, key: str = "search_id") -> DataFrame:
    """Of fetched pages ``(key, page, status, items)`` those before a search's first empty or refused one.

    Pages may be fetched at the same time; what lies behind the end is dropped.
    """
    ends = (F.coalesce(F.col("items"), F.lit(0)) == 0) | F.col("status").isin(403, 429)
    stop = fetched.groupBy(key).agg(F.min(F.when(ends, F.col("page"))).alias("_stop"))
    return fetched.join(stop, key).where(F.col("_stop").isNull() | (F.col("page") < F.col("_stop"))).drop("_stop")


def search_events(items: DataFrame) -> DataFrame:
    """Found items ``(html_url, number, title, body, user)`` as events; those whose URL names no repository are dropped.

    A search tells nothing of organisation, stars and commits: the first counts
    as given, the others are 0 and empty.
    """
    return items.select(
        F.concat(F.lit("search-"), repo_of_url(F.col("html_url")), F.lit("-"), F.col("number").cast("string")).alias("id"),
        F.lit("PullRequestEvent").alias("event_type"),
        repo_of_url(F.col("html_url")).alias("repository"),
        F.coalesce("user", F.lit("unknown")).alias("actor"),
        F.lit("merged").alias("action"),
        F.coalesce("number", F.lit(0)).cast("bigint").alias("pull_number"),
        F.lit("").alias("base_sha"),
        F.lit("").alias("merge_sha"),
        F.coalesce("title", F.lit("Untitled change")).alias("title"),
        F.coalesce("body", F.lit("")).alias("body"),
        F.lit(None).cast("string").alias("language_hint"),
        F.lit(0).cast("bigint").alias("stars"),
        F.lit(True).alias("has_org"),
    ).where("repository is not null")


def filter_payload(repository: Column, action: Column, language: Column) -> Column:
    """What filters look at, as a map; an unknown language is empty."""
    return F.create_map(F.lit("repo"), repository, F.lit("action"), action, F.lit("language"), F.coalesce(language, F.lit("")))


def repo_of_url(url: Column) -> Column:
    """``owner/name`` of an item URL, NULL unless it has both."""
    p = F.split(url, "/")
    return F.when(F.size(p) >= 5, F.concat_ws("/", F.try_element_at(p, F.lit(4)), F.try_element_at(p, F.lit(5))))
