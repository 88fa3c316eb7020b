"""Aggregates over events, tasks and runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.running import running_sum


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or NULL."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def funnel(rows: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """One row: how many rows pass each step and all before it, and the share of the step before."""
    passed, counts = F.lit(True), []
    for name, step in steps.items():
        passed = passed & F.coalesce(step, F.lit(False))
        counts.append(F.count_if(passed).alias(name))
    out = rows.agg(F.count("*").alias("total"), *counts)
    before = ["total", *list(steps)[:-1]]
    return out.select("*", *[ratio(F.col(n), F.col(b)).alias(f"{n}_rate") for n, b in zip(steps, before)])


def reason_histogram(rows: DataFrame, reasons: Column) -> DataFrame:
    """``reason, n``: the first word of every reason, in lower case; a row with several adds several."""
    word = F.lower(F.element_at(F.split(F.trim("r"), r"\s+"), 1))
    return rows.select(F.explode(reasons).alias("r")).groupBy(word.alias("reason")).agg(F.count("*").alias("n"))


def top_counts(rows: DataFrame, value: Column, n: int) -> DataFrame:
    """The n most frequent values, ties by value: ``value, n``."""
    counted = rows.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "value").limit(n)


def counts_by(rows: DataFrame, default: str = "unknown", **columns: Column) -> DataFrame:
    """Counts by columns, NULL as ``default``."""
    return rows.groupBy(*[F.coalesce(c, F.lit(default)).alias(k) for k, c in columns.items()]).agg(F.count("*").alias("n"))


def file_rollup(files: DataFrame, keys: Sequence[str], cap: int = 100) -> DataFrame:
    """Per key the number of files (at most ``cap``), the sums of their lines and their sorted names."""
    return files.groupBy(*keys).agg(
        F.least(F.count("*"), F.lit(cap)).alias("files"),
        F.sum("additions").alias("additions"),
        F.sum("deletions").alias("deletions"),
        F.sort_array(F.collect_set("filename")).alias("names"),
    )


def run_status(facts: DataFrame) -> DataFrame:
    """Verdict of a run from its command facts ``(task_id, phase, kind, exit_code, stderr)``.

    Phases: setup, base (before), agent, after. Kinds: f2p, p2p. Without a base
    phase the setup failed; a base run where a failing test passes or a passing
    one fails is insane; an agent that ends badly by a timeout is an error;
    otherwise all tests must pass after.
    """
    at = lambda p, k=None: (F.col("phase") == p) & (F.lit(True) if k is None else F.col("kind") == k)
    ok = F.col("exit_code") == 0
    timed_out = F.lower(F.coalesce("stderr", F.lit(""))).rlike("timeout|timed out")
    g = facts.groupBy("task_id").agg(
        F.count_if(at("base")).alias("base"),
        F.count_if((at("base", "f2p") & ok) | (at("base", "p2p") & ~ok)).alias("insane"),
        F.count_if(at("agent") & ~ok & timed_out).alias("stuck"),
        F.count_if(at("after")).alias("after"),
        F.count_if(at("after") & ok).alias("passed"),
    )
    status = (
        F.when(F.col("base") == 0, "setup_error")
        .when(F.col("insane") > 0, "sanity_fail")
        .when(F.col("stuck") > 0, "agent_error")
        .when((F.col("after") > 0) & (F.col("passed") == F.col("after")), "resolved")
        .otherwise("unresolved")
    )
    return g.select("task_id", status.alias("status"), "passed", F.col("after").alias("tests"))


def first_violation(facts: DataFrame, key: str, rules: Sequence[tuple[str, Column]], default: str) -> DataFrame:
    """``key, outcome``: the first rule in order that any fact of a key breaks, else ``default``."""
    hits = [F.when(F.max(F.coalesce(rule, F.lit(False))), F.lit(name)) for name, rule in rules]
    return facts.groupBy(key).agg(F.coalesce(*hits, F.lit(default)).alias("outcome"))


def process_validation(
    runs: DataFrame,
    required: Sequence[str],
    forbidden: Sequence[str],
    *,
    min_commands: int = 0,
    max_single: float | None = None,
    max_total: float | None = None,
    all_success: bool = False,
) -> DataFrame:
    """Per run whether its commands obey the rules, how many break one, and a score.

    ``runs(run_id, command, duration, exit_code)``; patterns are regular
    expressions. The score is the share of required patterns found, halved per
    forbidden pattern used, times 0.9 per other issue.
    """
    yes = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    used = [yes(F.col("command").rlike(p)) for p in forbidden]
    found = [yes(F.col("command").rlike(p)) for p in required]
    zero = F.lit(0).cast("bigint")
    add = lambda xs: sum(xs, zero)
    g = runs.groupBy("run_id").agg(
        F.count("*").alias("commands"),
        F.coalesce(F.sum("duration"), F.lit(0.0)).alias("total_duration"),
        add([F.when(x == 0, 1).otherwise(0) for x in found]).alias("missing"),
        add([F.when(x > 0, 1).otherwise(0) for x in used]).alias("forbidden"),
        add(used).alias("forbidden_hits"),
        (yes(F.col("duration") > max_single) if max_single is not None else F.max(zero)).alias("slow"),
        (yes(F.col("exit_code") != 0) if all_success else F.max(zero)).alias("failed"),
    )
    short = (F.col("commands") < min_commands).cast("bigint")
    late = (F.col("total_duration") > max_total).cast("bigint") if max_total is not None else zero
    issues = short + late + F.col("slow") + F.col("failed") + F.col("forbidden_hits") + F.col("missing")
    other = F.greatest(issues - F.col("missing") - F.col("forbidden"), zero)
    share = F.lit(1.0) if not required else (F.lit(len(required)) - F.col("missing")) / F.lit(float(len(required)))
    score = share * F.pow(F.lit(0.5), F.col("forbidden")) * F.pow(F.lit(0.9), other)
    return g.select(
        "run_id", "commands", "total_duration", issues.alias("issues"), (issues == 0).alias("valid"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score"),
    )


def running_total(rows: DataFrame, by: Column, order: Sequence[str], value: Column, limit: float | int) -> DataFrame:
    """``spent`` up to and including each row of its period, and whether the limit is reached. A period may hold any number of rows."""
    out = running_sum(rows.withColumn("period", by), ["period"], order, value, "spent")
    return out.withColumn("over", F.col("spent") >= limit)


def spending(rows: DataFrame, at: Column, value: Column, limits: Mapping[str, float | int]) -> DataFrame:
    """``period, start, spent, remaining, over`` per day and month of ``limits`` (keys ``day`` and ``month``)."""
    parts = [
        rows.groupBy(F.date_trunc(kind, at).cast("date").alias("start")).agg(F.coalesce(F.sum(value), F.lit(0)).alias("spent")).select(
            F.lit(kind).alias("period"), "start", "spent",
            F.greatest(F.lit(limit) - F.col("spent"), F.lit(0)).alias("remaining"), (F.col("spent") >= limit).alias("over"),
        )
        for kind, limit in limits.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def counters(rows: DataFrame, counts: Mapping[str, Column], sums: Mapping[str, Column] | None = None) -> DataFrame:
    """One row with a count per condition and a mean per value; NULL conditions do not count, a mean of nothing is 0."""
    means = [F.coalesce(F.avg(c), F.lit(0.0)).alias(k) for k, c in (sums or {}).items()]
    return rows.agg(F.count("*").alias("total"), *[F.count_if(c).alias(k) for k, c in counts.items()], *means)


def success_by_level(results: DataFrame, levels: Sequence[str], level: Column, success: Column, ms: Column) -> DataFrame:
    """``level, n, success_rate, mean_ms`` per level; unknown levels count as the middle one."""
    known = F.when(level.isin(list(levels)), level).otherwise(levels[len(levels) // 2])
    return results.groupBy(known.alias("level")).agg(
        F.count("*").alias("n"),
        F.avg(success.cast("double")).alias("success_rate"),
        F.floor(F.sum(ms) / F.count("*")).cast("bigint").alias("mean_ms"),
    )


def file_checks(files: DataFrame, checks: DataFrame) -> DataFrame:
    """``task_id, check_id, passed, required`` of checks against stored files.

    Kinds: exists, contains, not_contains (a missing file passes), regex,
    json_valid and line_count (at least). Unknown kinds fail.
    """
    j = checks.join(files.withColumnRenamed("path", "target"), ["task_id", "target"], "left")
    text, want = F.coalesce("content", F.lit("")), F.col("expected")
    there = F.col("content").isNotNull()
    lines = F.size(F.split(F.regexp_replace(text, "\n$", ""), "\n"))
    passed = (
        F.when(F.col("kind") == "exists", there)
        .when(F.col("kind") == "contains", there & text.contains(want))
        .when(F.col("kind") == "not_contains", ~text.contains(want))
        .when(F.col("kind") == "regex", there & F.expr("coalesce(content, '') rlike expected"))
        .when(F.col("kind") == "json_valid", there & F.try_parse_json(text).isNotNull())
        .when(F.col("kind") == "line_count", there & (F.when(text == "", 0).otherwise(lines) >= want.try_cast("bigint")))
        .otherwise(F.lit(False))
    )
    return j.select("task_id", "check_id", F.coalesce(passed, F.lit(False)).alias("passed"), "required")


def check_score(checks: DataFrame) -> DataFrame:
    """``task_id, passed, score``: all required checks passed, and the share of all checks (0.7 of the score)."""
    return checks.groupBy("task_id").agg(
        F.bool_and(F.col("passed") | ~F.col("required")).alias("passed"),
        (F.lit(0.7) * F.avg(F.col("passed").cast("double"))).alias("score"),
    )
