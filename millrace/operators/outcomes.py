"""Decisions over facts of runs, and what is said about many of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import named_level
from millrace.operators.reports import ratio
from millrace.operators.tasks import feasibility
from millrace.runtime import utrim


def _phases(facts: DataFrame) -> DataFrame:
    """Per task what its commands did: ``facts(task_id, phase, kind, exit_code)``, phases base, apply and after."""
    at = lambda p, k=None: (F.col("phase") == p) & (F.lit(True) if k is None else F.col("kind") == k)
    bad = F.coalesce(F.col("exit_code") != 0, F.lit(True))
    return facts.groupBy("task_id").agg(
        F.count_if(at("base", "f2p") & ~bad).alias("early"),
        F.count_if(at("base", "p2p") & bad).alias("broken"),
        F.count_if(at("apply") & ~bad).alias("applied"),
        F.count_if(at("apply")).alias("tried"),
        F.count_if(at("after", "f2p") & bad).alias("failing"),
        F.count_if(at("after", "p2p") & bad).alias("regressed"),
    )


def _n(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def workspace_outcome(tasks: DataFrame, facts: DataFrame) -> DataFrame:
    """``task_id, outcome``: the first thing wrong with a task, else ``passed``.

    ``tasks(id, prompt, fail_to_pass, patch, test_files array<string>)``. In this order:
    the prompt, no failing tests, a failing test that passes before, a passing
    one that fails before, an empty patch, one that no attempt could apply, a
    failing test that still fails after, a passing one that fails after.
    """
    j = tasks.join(_phases(facts), tasks["id"] == F.col("task_id"), "left")
    prompt = feasibility(F.col("prompt"), F.coalesce("fail_to_pass", F.array().cast("array<string>")), F.coalesce("test_files", F.array().cast("array<string>")))
    outcome = (
        F.when(prompt.isNotNull(), F.concat(F.lit("prompt: "), prompt))
        .when(F.coalesce(F.size("fail_to_pass"), F.lit(0)) <= 0, "no failing tests")
        .when(_n("early") > 0, "passes before")
        .when(_n("broken") > 0, "broken before")
        .when(utrim(F.coalesce("patch", F.lit(""))) == "", "empty patch")
        .when((_n("tried") > 0) & (_n("applied") == 0), "not applied")
        .when(_n("failing") > 0, "still fails")
        .when(_n("regressed") > 0, "regression")
        .otherwise("passed")
    )
    return j.select(F.col("id").alias("task_id"), outcome.alias("outcome"))


def dual_commit(tasks: DataFrame, facts: DataFrame) -> DataFrame:
    """``task_id, accepted``: an empty patch is accepted; otherwise it must apply, and every test pass with it."""
    j = tasks.join(_phases(facts), tasks["id"] == F.col("task_id"), "left")
    empty = utrim(F.coalesce("patch", F.lit(""))) == ""
    bad = ((_n("tried") > 0) & (_n("applied") == 0)) | (_n("failing") > 0) | (_n("regressed") > 0)
    return j.select(F.col("id").alias("task_id"), (empty | ~bad).alias("accepted"))


STATUSES = ("resolved", "unresolved", "agent_error", "test_error", "setup_error", "sanity_fail")


def run_summary(results: DataFrame) -> DataFrame:
    """One row: runs, a count per status, and the mean agent time over those that took any, to a tenth.

    ``results(status, agent_seconds)``; no such run gives 0.
    """
    took = F.avg(F.when(F.col("agent_seconds") > 0, F.col("agent_seconds")))
    return results.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        (F.round(F.coalesce(took, F.lit(0.0)) * 10) / 10).alias("mean_agent_seconds"),
    )


def evaluation_summary(results: DataFrame) -> DataFrame:
    """One row over ``results(success, ms)``: status, tasks, successes, success rate, whole mean milliseconds. Empty counts as failed."""
    wins = F.count_if(F.col("success"))
    n = F.count("*")
    return results.agg(
        F.when(wins > 0, "success").otherwise("failed").alias("status"),
        n.alias("tasks"),
        wins.alias("successes"),
        F.coalesce(F.try_divide(wins.cast("double"), n.cast("double")), F.lit(0.0)).alias("success_rate"),
        F.when(n > 0, F.expr("sum(ms) div count(*)")).otherwise(F.lit(0).cast("bigint")).alias("mean_ms"),
    )


def level_rates(results: DataFrame) -> DataFrame:
    """``level, tasks, success_rate, mean_ms``; unknown levels, NULL too, count as medium."""
    return results.groupBy(named_level(F.col("level")).alias("level")).agg(
        F.count("*").alias("tasks"),
        F.avg(F.coalesce(F.col("success"), F.lit(False)).cast("double")).alias("success_rate"),
        F.expr("sum(ms) div count(*)").alias("mean_ms"),
    )


def advice(results: DataFrame) -> DataFrame:
    """``advice`` on the tasks, one row each: on all of them by the overall success rate, on easy and hard ones by their own."""
    wins = F.count_if(F.col("success"))
    whole = results.agg(ratio(wins, F.count("*")).alias("rate")).select(
        F.explode(
            F.when(F.col("rate") > 0.8, F.array(F.lit("too easy: raise the difficulty"), F.lit("too easy: add traps and edge cases")))
            .when(F.col("rate") < 0.2, F.array(F.lit("too hard: review the statements"), F.lit("too hard: simplify or add context")))
            .otherwise(F.array(F.lit("well calibrated")))
        ).alias("advice")
    )
    per = results.groupBy(F.lower(F.coalesce("level", F.lit("unknown"))).alias("level")).agg(ratio(wins, F.count("*")).alias("rate"))
    own = F.when((F.col("level") == "easy") & (F.col("rate") < 0.7), "easy tasks are too hard").when(
        (F.col("level") == "hard") & (F.col("rate") > 0.5), "hard tasks are too easy"
    )
    return whole.unionByName(per.select(own.alias("advice")).where("advice is not null"))


# What an agent says when it is done.
DONE = ("TASK COMPLETE",)


def says_done(output: Column, phrases: Sequence[str] = DONE) -> Column:
    """Whether an output holds one of the phrases, as written."""
    out = F.lit(False)
    for p in phrases:
        out = out | F.coalesce(output, F.lit("")).contains(p)
    return out


def last_attempts(facts: DataFrame, key: Sequence[str] = ("task_id", "command")) -> DataFrame:
    """Of repeated attempts ``(*key, attempt, ...)`` the last one of each key, as it is recorded."""
    rest = [c for c in facts.columns if c not in key]
    last = facts.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col("attempt")).alias("_last"))
    return last.select(*key, *[F.col(f"_last.`{c}`").alias(c) for c in rest])


def has_tests(fail_to_pass: Column, pass_to_pass: Column) -> Column:
    return (F.coalesce(F.size(fail_to_pass), F.lit(0)) > 0) | (F.coalesce(F.size(pass_to_pass), F.lit(0)) > 0)


def succeeded(status: Column, exit_code: Column) -> Column:
    """Whether a run completed and ended well."""
    return F.coalesce((status == "completed") & (exit_code == 0), F.lit(False))


def partial_credit(criteria: DataFrame, files: DataFrame) -> DataFrame:
    """``task_id, criterion, points`` of criteria that are met: no file is named, or it exists and holds the pattern, if there is one.

    ``criteria(task_id, criterion, points, file, pattern)``, ``files(task_id, path, content)``.
    """
    f = files.select(F.col("task_id").alias("_t"), F.col("path").alias("_p"), F.coalesce("content", F.lit("")).alias("_c"))
    j = criteria.join(f, (F.col("task_id") == F.col("_t")) & (F.col("file") == F.col("_p")), "left")
    met = F.col("file").isNull() | (F.col("_p").isNotNull() & (F.col("pattern").isNull() | F.col("_c").contains(F.col("pattern"))))
    return j.where(met).select("task_id", "criterion", "points")


def verifier_score(checks: DataFrame, credits: DataFrame) -> DataFrame:
    """``task_id, passed, score``: the share of checks weighs 0.7 and the points of credits 0.3, 1 at most; no checks, no score.

    ``passed`` asks for the required checks only, and is true without any.
    """
    c = checks.groupBy("task_id").agg(
        F.avg(F.col("passed").cast("double")).alias("share"), F.bool_and(F.col("passed") | ~F.col("required")).alias("ok")
    )
    p = credits.groupBy("task_id").agg(F.sum("points").alias("points"))
    return c.join(p, "task_id", "full").select(
        "task_id",
        F.coalesce("ok", F.lit(True)).alias("passed"),
        F.coalesce(F.least(F.col("share") * 0.7 + F.coalesce("points", F.lit(0.0)) * 0.3, F.lit(1.0)), F.lit(0.0)).alias("score"),
    )


def canary_hits(outputs: DataFrame, canaries: DataFrame) -> DataFrame:
    """``output_id, task_id, confidence`` of outputs that hold any canary, not only their own task's.

    ``outputs(output_id, text)``, ``canaries(task_id, canary)``. Identifiers are
    cut out of the outputs and joined by equality, so no output meets a canary
    it does not hold: whole ids in any case first (1.0), then their hashes (0.95).
    """
    ids = F.transform(F.regexp_extract_all(F.upper("text"), F.lit(r"CANARY-[0-9A-F]{8}(?:-[0-9A-F]{4}){3}-[0-9A-F]{12}"), 0), lambda x: x)
    hashes = F.regexp_extract_all("text", F.lit(r"[0-9a-f]{64}"), 0)
    held = outputs.select("output_id", F.explode(F.array_distinct(F.concat(ids, hashes))).alias("held"))
    known = canaries.select("task_id", F.upper("canary").alias("held"), F.lit(1.0).alias("confidence")).unionByName(
        canaries.select("task_id", F.sha2("canary", 256).alias("held"), F.lit(0.95).alias("confidence"))
    )
    return held.join(known, "held").groupBy("output_id", "task_id").agg(F.max("confidence").alias("confidence"))


PATTERNS = 1000


def pattern_hits(commands: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern, n``: commands that match each pattern of a table of at most ``PATTERNS``; more are an error.

    The patterns become one expression over the commands, so nothing is multiplied.
    """
    rows = [r[0] for r in patterns.where("pattern is not null").select("pattern").distinct().orderBy("pattern").limit(PATTERNS + 1).collect()]
    if len(rows) > PATTERNS:
        raise ValueError(f"more than {PATTERNS} patterns")
    hits = F.filter(F.array(*[F.when(F.col("command").rlike(p), F.lit(p)) for p in rows]).cast("array<string>"), lambda x: x.isNotNull())
    counted = commands.select(F.explode(hits).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n"))
    every = patterns.where("pattern is not null").select("pattern").distinct()
    return every.join(counted, "pattern", "left").select("pattern", F.coalesce("n", F.lit(0)).alias("n"))


def test_ratio(facts: DataFrame) -> DataFrame:
    """``task_id, f2p, p2p``: how many of the failing and of the passing tests pass afterwards, as ``passed/all``."""
    after, ok = F.col("phase") == "after", F.col("exit_code") == 0

    def part(kind: str) -> Column:
        of = after & (F.col("kind") == kind)
        return F.concat(F.count_if(of & ok).cast("string"), F.lit("/"), F.count_if(of).cast("string")).alias(kind)

    return facts.groupBy("task_id").agg(part("f2p"), part("p2p"))


def run_checks(checks: DataFrame, results: DataFrame) -> DataFrame:
    """``task_id, check_id, passed`` of checks of commands from their recorded results.

    ``checks(task_id, check_id, kind, command, expected)``, ``results(task_id, command, stdout, exit_code)``. Kinds:
    command_succeeds, command_output (holds the expected text), exit_code. A command without result fails.
    """
    r = results.select(F.col("task_id").alias("_t"), F.col("command").alias("_c"), "stdout", "exit_code")
    j = checks.join(r, (F.col("task_id") == F.col("_t")) & (F.col("command") == F.col("_c")), "left")
    passed = (
        F.when(F.col("kind") == "command_succeeds", F.col("exit_code") == 0)
        .when(F.col("kind") == "command_output", F.col("stdout").contains(F.col("expected")))
        .when(F.col("kind") == "exit_code", F.col("exit_code") == F.col("expected").try_cast("int"))
    )
    return j.select("task_id", "check_id", F.coalesce(passed, F.lit(False)).alias("passed"))


def traces(runs: DataFrame, steps: DataFrame, scores: DataFrame, artifacts: DataFrame) -> DataFrame:
    """``run_id, steps, score, artifacts`` of every run; what refers to it is counted before it is joined."""
    count = lambda d, name: d.groupBy("run_id").agg(F.count("*").alias(name))
    best = scores.groupBy("run_id").agg(F.max("score").alias("score"))
    j = runs.select("run_id").join(count(steps, "steps"), "run_id", "left").join(best, "run_id", "left")
    j = j.join(count(artifacts, "artifacts"), "run_id", "left")
    return j.select("run_id", _n("steps").alias("steps"), "score", _n("artifacts").alias("artifacts"))
