"""Columns and small relations of tasks: texts, scores, decisions, traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import command_paths
from millrace.runtime import utrim


def original_text(repo: Column, number: Column, title: Column, body: Column) -> Column:
    """``repo (#n): title``, a blank line, and the body or a note that there is none."""
    rest = F.when(F.coalesce(body, F.lit("")) == "", "(no description)").otherwise(body)
    return F.concat(repo, F.lit(" (#"), number.cast("string"), F.lit("): "), title, F.lit("\n\n"), rest)


def provenance(**columns: Column) -> Column:
    """A string map of where a row comes from; entries without a value are left out."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in columns.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def feasibility(prompt: Column, commands: Column, files: Column) -> Column:
    """Why a prompt cannot stand alone, NULL if it can.

    In this order: it is blank, shorter than 100 bytes, or gives away a test
    command or the base name of a test file.
    """
    text = utrim(F.coalesce(prompt, F.lit("")))
    low = F.lower(text)
    names = lambda f: F.lower(F.substring_index(f, "/", -1))
    return (
        F.when(text == "", "empty")
        .when(F.octet_length(text) < 100, "short")
        .when(F.exists(commands, lambda c: (F.trim(c) != "") & low.contains(F.lower(F.trim(c)))), "names a command")
        .when(F.exists(files, lambda f: (names(f) != "") & low.contains(names(f))), "names a file")
    )


# Ways in which tests read source files instead of running them.
SOURCE_READING = (
    r"open\([^)]*\)\.read",
    r"Path\([^)]*\)\.read_text",
    r"\.read\(\)[^;]*assert.*\bin\b",
    r"readFileSync\(",
    r"readFile\(",
    r"assert.*\bin\s+(?:source|content|text|code|file_content|src|contents)",
    r"\.(?:includes|contains)\(['\"]",
)
BEHAVIOUR = ("import ", "require(", "from ", "fetch(", "request(")
ASSERTS = r"assert|expect\(|Assert\."


def reads_sources(content: Column) -> Column:
    """How many ways of reading sources make a test file unfit.

    A way counts if its uses exceed half of the assertions, or if nothing in
    the file exercises behaviour; files without assertions are never unfit.
    """
    asserts = F.regexp_count(content, F.lit(ASSERTS))
    behaves = F.lit(False)
    for b in BEHAVIOUR:
        behaves = behaves | content.contains(b)
    total = F.lit(0)
    for p in SOURCE_READING:
        n = F.regexp_count(content, F.lit(p))
        total = total + F.when((n > 0) & (asserts > 0) & ((n * 2 > asserts) | ~behaves), 1).otherwise(0)
    return total


def created_files(outputs: DataFrame, given: DataFrame) -> DataFrame:
    """``task_id, path`` of files that a run made: not given to it, no dot files."""
    mine = outputs.where(~F.substring_index("path", "/", -1).startswith(".")).select("task_id", "path").distinct()
    return mine.join(given.select("task_id", "path"), ["task_id", "path"], "left_anti")


def unknown_references(commands: DataFrame, files: DataFrame) -> DataFrame:
    """``task_id, ref`` of test files named by commands but present neither by path nor by base name."""
    refs = commands.select("task_id", F.explode(command_paths(F.col("command"))).alias("ref")).distinct()
    base = lambda c: F.substring_index(c, "/", -1)
    by_path = refs.join(files.select("task_id", F.col("path").alias("ref")), ["task_id", "ref"], "left_anti")
    names = files.select("task_id", base(F.col("path")).alias("name")).distinct()
    return by_path.withColumn("name", base(F.col("ref"))).join(names, ["task_id", "name"], "left_anti").select("task_id", "ref")


def difficulty_score(mean_time: Column, success: Column, hints: Column) -> Column:
    """Time (of an hour), failure and hints (of five) weighed 0.4, 0.4 and 0.2, within 0..1."""
    one, zero = F.lit(1.0), F.lit(0.0)
    fail = one - F.greatest(zero, F.least(one, success))
    score = 0.4 * F.least(mean_time / 3600.0, one) + 0.4 * fail + 0.2 * F.least(hints / 5.0, one)
    return F.greatest(zero, F.least(one, score))


def level_of(score: Column) -> Column:
    return F.when(score < 0.34, "easy").when(score < 0.67, "medium").otherwise("hard")


def select_message(arguments: Column, content: Column, *rest: Column) -> Column:
    """The first that is not blank of a tool call's arguments, the content, and the reasoning fields."""
    return F.coalesce(*[F.when(utrim(c) != "", c) for c in (arguments, content, *rest)])


def safe_name(c: Column) -> Column:
    """Slashes as dashes, spaces as underscores."""
    return F.translate(c, "/ ", "-_")


def shell_quote(c: Column) -> Column:
    """A single-quoted shell word."""
    return F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("'\\''")), F.lit("'"))


def mask(c: Column) -> Column:
    """A key with only its ends readable; short ones not at all."""
    return F.when(F.length(c) <= 8, F.repeat(F.lit("*"), F.length(c))).otherwise(F.concat(F.left(c, F.lit(4)), F.lit("..."), F.right(c, F.lit(4))))


def number_steps(steps: DataFrame, by: str, order: Sequence[str]) -> DataFrame:
    """``step`` from 1 and the seconds ``since`` the step before; steps of one run stay together."""
    w = Window.partitionBy(by).orderBy(*order)
    t = F.col(order[0]).cast("timestamp")
    return steps.withColumn("step", F.row_number().over(w)).withColumn(
        "since", (F.unix_micros(t) - F.lag(F.unix_micros(t)).over(w)) / 1e6
    )


def trace_totals(steps: DataFrame, by: str) -> DataFrame:
    """Steps, time and tokens per run; cached tokens do not count."""
    return steps.groupBy(by).agg(
        F.count("*").alias("steps"),
        F.coalesce(F.sum("duration"), F.lit(0.0)).alias("duration"),
        F.coalesce(F.sum(F.col("tokens_in") + F.col("tokens_out")), F.lit(0)).alias("tokens"),
    )


def best_offer(requests: DataFrame, offers: DataFrame, need: str, room: str, rank: Sequence[str]) -> DataFrame:
    """For each request the first offer by ``rank`` with enough room: ``request_id, name``.

    The smallest fitting room decides which offers remain, and the best of
    every suffix of rooms is worked out once on the offers. Requests then look
    up their step, so nothing is multiplied: both sides are ordered by room
    and the running value carries over.
    """
    w = Window.orderBy(F.desc(room)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    order = F.struct(*[F.col(c) for c in rank], F.col("name"))
    steps = offers.groupBy(room).agg(F.min(order).alias("o")).select(
        F.col(room).alias("at"), F.min("o").over(w)["name"].alias("name")
    )
    ladder = steps.groupBy().agg(F.sort_array(F.collect_list(F.struct("at", "name"))).alias("ladder")).first()["ladder"]
    pick = F.lit(None).cast("string")
    for step in reversed(ladder or []):  # as many steps as offers have rooms
        pick = F.when(F.col(need) <= F.lit(step["at"]), F.lit(step["name"])).otherwise(pick)
    return requests.select("request_id", pick.alias("name"))


def log_levels(lines: DataFrame) -> DataFrame:
    """``level, n`` of log lines; lines without a level count as OTHER."""
    level = F.upper(F.regexp_extract("value", r"\b(ERROR|WARN|INFO|DEBUG|TRACE)\b", 1))
    return lines.groupBy(F.when(level == "", "OTHER").otherwise(level).alias("level")).agg(F.count("*").alias("n"))


def submission(attempts: DataFrame, rules: Sequence[tuple[str, Column, bool]], retries: int = 3) -> DataFrame:
    """Decision on each submission ``(task_id, attempt, ...)``: accepted, retry or refused, and why.

    Rules are tried in order: name, condition of violation, whether it refuses
    for good. The first ``retries`` violations of a task ask for a retry;
    afterwards only rules that refuse for good still count.
    """
    first = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c, _ in rules], F.lit(None).cast("string"))
    hard = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c, good in rules if good], F.lit(None).cast("string"))
    w = Window.partitionBy("task_id").orderBy("attempt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    judged = attempts.withColumn("_first", first).withColumn("_hard", hard)
    judged = judged.withColumn("_n", F.sum(F.col("_first").isNotNull().cast("int")).over(w))
    verdict = (
        F.when(F.col("_first").isNull(), "accepted")
        .when(F.col("_n") <= retries, "retry")
        .when(F.col("_hard").isNotNull(), "refused")
        .otherwise("accepted")
    )
    reason = F.when(verdict == "retry", F.col("_first")).when(verdict == "refused", F.col("_hard"))
    return judged.select("task_id", "attempt", verdict.alias("decision"), reason.alias("reason"))
