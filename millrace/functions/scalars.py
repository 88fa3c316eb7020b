"""Small functions over models, tasks, tools and sizes, as Column builders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.integrity import canary_id
from millrace.functions.text import truncate_bytes
from millrace.runtime import utrim

# Per level its score range, expected seconds, command steps, success rate, points, time bonus and limits.
LEVELS = {
    "easy": (0.0, 0.33, 180, 360, 5, 10, 0.90, 10.0, 5.0, 1, 100),
    "medium": (0.34, 0.66, 480, 900, 10, 25, 0.70, 25.0, 15.0, 5, 256),
    "hard": (0.67, 1.0, 900, 3600, 25, 50, 0.40, 50.0, 30.0, 10, 512),
}
LEVEL_COLUMNS = (
    "level string, score_from double, score_to double, seconds_from int, seconds_to int, steps_from int, steps_to int,"
    " success_rate double, points double, time_bonus double, disk_gb int, processes int"
)


def level_table(spark: SparkSession) -> DataFrame:
    """The constants of the levels, one row each."""
    return spark.createDataFrame([(k, *v) for k, v in LEVELS.items()], LEVEL_COLUMNS)


def by_key(key: Column, values: Mapping[str, object], otherwise: object = None) -> Column:
    """A value by key; the mapping is a handful of constants."""
    out = F.lit(otherwise)
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def named_level(c: Column) -> Column:
    """easy and hard in any case; everything else, NULL too, is medium."""
    return F.when(F.lower(c).isin("easy", "hard"), F.lower(c)).otherwise("medium")


def level_of_score(score: Column, medium: float = 0.34, hard: float = 0.67) -> Column:
    """The level of a score by two thresholds."""
    return F.when(score < medium, "easy").when(score < hard, "medium").otherwise("hard")


def score_of_level(level: Column) -> Column:
    """1 for easy, 2 for medium, 3 for hard, else 1."""
    return by_key(level, {"medium": 2, "hard": 3}, 1).cast("int")


def label_of(score: Column, fallback: Column) -> Column:
    """Hard from 0.8, Medium from 0.5, else Easy; of the score, or the fallback where there is none."""
    s = F.coalesce(score, fallback.cast("double"))
    return F.when(s >= 0.8, "Hard").when(s >= 0.5, "Medium").otherwise("Easy")


def task_score(level: Column, success: Column, partial: Column, taken: Column, expected: Column, valid: Column) -> Column:
    """Points of an attempt: half of the base by what was completed; with success the base, a bonus for time and a tenth for a valid process."""
    base = by_key(level, {k: v[7] for k, v in LEVELS.items()})
    most = by_key(level, {k: v[8] for k, v in LEVELS.items()})
    quick = (taken < expected) & (expected > 0)
    bonus = F.when(quick, most * F.least((1.0 - taken / expected) / 0.5, F.lit(1.0))).otherwise(0.0)
    whole = base + bonus + F.when(valid, base * 0.1).otherwise(0.0)
    return F.when(success, whole).otherwise(base * 0.5 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), partial)))


def expected_seconds(level: Column, minutes: Column) -> Column:
    """Minutes as seconds, within the range of the level."""
    low, high = (by_key(level, {k: v[i] for k, v in LEVELS.items()}) for i in (2, 3))
    return F.least(F.greatest(minutes * 60, low), high).cast("bigint")


def expected_steps(level: Column) -> Column:
    """One above the fewest steps of easy, the middle of medium, two below the most of hard."""
    steps = {"easy": LEVELS["easy"][4] + 1, "medium": (LEVELS["medium"][4] + LEVELS["medium"][5]) // 2, "hard": LEVELS["hard"][5] - 2}
    return by_key(level, steps).cast("int")


# --------------------------------------------------------------------- models
# Names by which models that reason are known; with a slash from the start, with a dash at the end or
# before another dash, else as whole words.
REASONING = (
    "moonshotai/kimi kimi-k2 kimi-k1 openai/o1 openai/o3 o1-preview o1-mini o3-mini deepseek/deepseek-r1 deepseek-r1"
    " deepseek-reasoner -thinking -reasoning"
).split()


def reasons(model: Column) -> Column:
    """Whether a model reasons, by its name in any case. A word's first place in the name decides."""
    low = F.lower(model)
    out = F.lit(False)
    for p in REASONING:
        if "/" in p:
            out = out | low.startswith(p)
        elif p.startswith("-"):
            out = out | low.endswith(p) | low.contains(p + "-")
        else:
            q = p.replace("-", "\\-")
            out = out | low.rlike(rf"(?U)^(?:(?!{q}).)*?(?<![\p{{L}}\p{{N}}]){q}(?![\p{{L}}\p{{N}}])")
    return out


def token_limit(model: Column, asked: Column, structured: Column) -> Column:
    """The token limit of a request: models that reason get room for it, unless the output is structured."""
    return F.when(reasons(model) & ~structured, F.greatest(F.coalesce(asked, F.lit(4000)) + 8000, F.lit(16000))).otherwise(asked)


def transient(kind: Column, message: Column, code: Column) -> Column:
    """Whether a failed call is worth another try: rate limits, server errors, and network trouble by its wording."""
    trouble = message.contains("timeout") | message.contains("connection") | message.contains("temporarily") | message.contains("Connection refused")
    return F.coalesce(
        F.when(kind == "rate_limited", True).when(kind == "api", (code >= 500) | (code == 429)).when(kind == "request", trouble).otherwise(False),
        F.lit(False),
    )


def model_fit(code: Column, level: Column, hinted: Column, coding: Column, reasoning: Column, speed: Column) -> Column:
    """How well a model fits a request: by what is asked for, else all abilities alike."""
    asked = (
        F.when(code, coding * 3.0).otherwise(0.0)
        + F.when(level.isin("hard", "expert"), reasoning * 2.0).otherwise(0.0)
        + F.when(level.isin("easy", "simple"), speed * 1.5).otherwise(0.0)
    )
    return F.when(hinted, asked).otherwise(coding + reasoning + speed)


def cacheable(role: Column, user: bool = False, assistant: bool = False) -> Column:
    """Whether messages of a role are kept: system always, user and assistant if asked for, others never."""
    return F.coalesce(by_key(role, {"system": True, "user": user, "assistant": assistant}, False), F.lit(False))


# Spellings of agents and of checks.
AGENTS = {
    "baseagent": "base", "base-agent": "base", "base": "base", "claude": "claude_code", "claude-code": "claude_code",
    "claudecode": "claude_code", "aider": "aider", "generic": "generic", "custom": "custom",
}
CHECKS = {
    x: kind
    for kind in ("file_exists", "output_contains", "output_matches", "command_succeeds", "exit_code")
    for x in (kind, kind.replace("_", ""))
}


def agent_kind(c: Column) -> Column:
    """The agent of a name in any case; NULL if there is none."""
    return by_key(F.lower(c), AGENTS)


def check_kind(c: Column) -> Column:
    """The check of a name in any case; everything else is custom."""
    return by_key(F.lower(c), CHECKS, "custom")


# ------------------------------------------------------------- tools and texts
def tool_answer(stdout: Column, stderr: Column) -> Column:
    """What a tool says: its error, or its output with a note on the lines; else the raw output, the error stream, or that there is none."""
    v = F.try_parse_json(stdout)
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    total = get("$.total_lines", "bigint")
    shown = F.concat(
        F.lit("\n\n[Showing "), F.coalesce(get("$.shown_lines", "bigint"), F.lit(0)).cast("string"), F.lit("/"), total.cast("string"),
        F.lit(" lines. Use offset/limit to see more.]"),
    )
    whole = F.concat(F.lit("\n\n["), total.cast("string"), F.lit(" total lines]"))
    note = F.when(total.isNull(), "").when(F.coalesce(get("$.truncated", "boolean"), F.lit(False)), shown).otherwise(whole)
    said = F.coalesce(get("$.error", "string"), F.concat(get("$.output", "string"), note), stdout)
    return (
        F.when(F.coalesce(stdout, F.lit("")) != "", said)
        .when(F.coalesce(stderr, F.lit("")) != "", F.concat(F.lit("Error: "), truncate_bytes(stderr, 1500)))
        .otherwise("No output")
    )


def json_error(status: Column, partial: Column, content: Column) -> Column:
    """``struct<error, preview>`` of a recovery of JSON that failed: of cut JSON 100 bytes, of other text 50."""
    return F.when(status == "truncated", F.struct(F.lit("truncated").alias("error"), truncate_bytes(partial, 100).alias("preview"))).when(
        status == "not_found", F.struct(F.lit("not_found").alias("error"), truncate_bytes(utrim(content), 50).alias("preview"))
    )


def embed_canary(content: Column, canary: Column, place: Column) -> Column:
    """``content`` below a comment line with the canary and its place."""
    mark = F.concat(F.lit("<!-- "), canary, F.lit(" [loc:"), F.replace(place, F.lit(" "), F.lit("_")), F.lit("] -->"))
    return F.concat(mark, F.lit("\n"), content)


def prefixed_canary(task_id: Column, seed: int, prefix: str) -> Column:
    return F.concat(F.lit(prefix), canary_id(task_id, seed))


def run_values(task_id: Column, at: Column, level: Column, seed: int) -> Column:
    """Values that differ from run to run (time, session, and with obfuscation a suffix), from a seeded hash instead of chance."""
    h = F.sha2(F.concat_ws("|", F.lit(str(seed)), task_id), 256)
    base = F.create_map(F.lit("generation_timestamp"), F.unix_seconds(at).cast("string"), F.lit("session_id"), F.left(h, F.lit(32)))
    return F.when(level > 0, F.map_concat(base, F.create_map(F.lit("random_suffix"), F.right(h, F.lit(8))))).otherwise(base)


def env_escape(c: Column) -> Column:
    """Backslashes, quotes and dollars behind a backslash."""
    for x in ("\\", '"', "$"):
        c = F.replace(c, F.lit(x), F.lit("\\" + x))
    return c


def package_name(c: Column) -> Column:
    """Letters and digits of any script and ``- _ . : +``, at least one."""
    return c.rlike(r"\A[\p{L}\p{N}_.:+-]+\z")


def packages(names: Column) -> Column:
    """Those of a list that are package names."""
    return F.filter(names, package_name)


def tool_name(c: Column) -> Column:
    return c.rlike(r"\A[A-Za-z0-9_]*\z")


def port_of(n: Column) -> Column:
    """The n-th port of the range 10000 to 60000, from 0, around and around."""
    return (F.pmod(n, F.lit(50_001)) + 10_000).cast("bigint")


def memory_text(size: Column) -> Column:
    """Bytes as whole gigabytes, or megabytes below one."""
    mb = F.floor(size / (1 << 20))
    return F.when(mb >= 1024, F.concat(F.floor(mb / 1024).cast("string"), F.lit("G"))).otherwise(F.concat(mb.cast("string"), F.lit("M")))


def cpu_quota(cores: Column, period: int = 100_000) -> Column:
    return (cores * period).cast("bigint")


def volume_text(host: Column, inside: Column, read_only: Column) -> Column:
    return F.concat(host, F.lit(":"), inside, F.when(read_only, ":ro").otherwise(""))


# Images by what the tags of a task hold, in this order.
IMAGES = (
    (("python",), "python:3.11-slim"),
    (("node", "javascript"), "node:20-slim"),
    (("rust",), "rust:1.75-slim"),
    (("go",), "golang:1.21-alpine"),
)


def base_image(tags: Column, category: Column, default: str) -> Column:
    """The image by the first kind of tag that a task has; a category may name python, or containers if no tag fits."""
    low, kind = F.transform(tags, F.lower), F.lower(category)
    out = F.when(kind.contains("docker") | kind.contains("container"), "docker:24-dind").otherwise(default)
    for words, image in reversed(IMAGES):
        held = F.exists(low, lambda t: t.rlike("|".join(words)))
        if image.startswith("python"):
            held = held | kind.contains("python")
        out = F.when(held, image).otherwise(out)
    return out


def retry_delays(attempts: Column, first: float = 1.0) -> Column:
    """The seconds to wait before each further attempt: twice as long every time."""
    return F.when(attempts > 1, F.transform(F.sequence(F.lit(0), attempts - 2), lambda k: F.lit(first) * F.pow(F.lit(2.0), k))).otherwise(
        F.array().cast("array<double>")
    )


def newer(version: Column, than: Column) -> Column:
    """Whether a version of dotted numbers (a leading v aside) is above another; NULL if either is none."""

    def parts(c: Column) -> Column:
        clean = F.regexp_replace(c, r"^v|[-+].*$", "")
        numbers = F.transform(F.split(clean, r"\."), lambda x: x.try_cast("bigint"))
        return F.when(clean.rlike(r"^\d+(?:\.\d+){0,2}$"), F.slice(F.concat(numbers, F.array_repeat(F.lit(0).cast("bigint"), 3)), 1, 3))

    return parts(version) > parts(than)


def pace(done: Column, total: Column, seconds: Column, last: Column, stall: float = 600.0) -> Column:
    """``struct<per_hour, eta_seconds, stalled>`` of a run: its pace, the time to its end at it, and whether nothing came for long."""
    rate = F.when(seconds > 0, done / seconds)
    return F.struct(
        F.coalesce(rate * 3600, F.lit(0.0)).alias("per_hour"),
        F.when(rate > 0, (total - done) / rate).alias("eta_seconds"),
        (seconds - last >= stall).alias("stalled"),
    )


def script_issues(files: DataFrame) -> DataFrame:
    """``task_id, path, issue, ref``: shell files without shebang or content, and test files that lines name but nobody submitted.

    ``files(task_id, path, content)``.
    """
    text = F.coalesce("content", F.lit(""))
    shell = F.col("path").rlike(r"\.(?:sh|bash)$")
    kinds = F.array_compact(F.array(F.when(~F.ltrim(text).startswith("#!"), "no shebang"), F.when(utrim(text) == "", "empty")))
    own = files.where(shell).select("task_id", "path", F.explode(kinds).alias("issue"), F.lit(None).cast("string").alias("ref"))
    tokens = F.filter(F.split(text, r"\s+"), lambda t: t.rlike(r"^(?:\./)?tests/.*\.(?:py|js|ts|sh)$"))
    refs = files.select("task_id", "path", F.explode(F.array_distinct(F.transform(tokens, lambda t: F.regexp_replace(t, r"^\./", "")))).alias("ref"))
    known = files.select("task_id", F.col("path").alias("ref"))
    missing = refs.join(known, ["task_id", "ref"], "left_anti").select("task_id", "path", F.lit("not submitted").alias("issue"), "ref")
    return own.unionByName(missing)


