"""From changes to tasks, and from tasks to what is handed out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import label_of
from millrace.functions.text import line_delta, split_diff
from millrace.operators.tasks import original_text

# Per language (with its other names) how it is built and tested, and how it is set up.
COMMANDS = (
    (("python",), "pip install -e .", "pytest"),
    (("rust",), "cargo build", "cargo test"),
    (("go", "golang"), "go build ./...", "go test ./..."),
    (("javascript", "typescript", "js", "ts"), "npm install", "npm test"),
    (("java", "kotlin"), "./mvnw -q -DskipTests package", "./mvnw test"),
)
SETUP = (
    (("python",), {"python": "3.11", "install": "pip install -e .", "test_cmd": "pytest"}),
    (("javascript", "typescript", "js", "ts"), {"node": "20", "install": "npm install", "test_cmd": "npm test"}),
    (("go",), {"go": "1.22", "install": "go mod download", "test_cmd": "go test ./..."}),
    (("rust",), {"rust": "1.75", "install": "cargo fetch", "test_cmd": "cargo test"}),
    (("java",), {"java": "21", "install": "./mvnw -q -DskipTests package", "test_cmd": "./mvnw test"}),
)
NO_SETUP = {"install": "# manual install", "test_cmd": "# manual test command"}


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def commands_for(language: Column) -> Column:
    """``struct<build array, test array>`` of a language in any case; empty lists for others."""
    low = F.lower(language)
    none = F.array().cast("array<string>")
    out = F.struct(none.alias("build"), none.alias("test"))
    for names, build, test in COMMANDS:
        out = F.when(low.isin(*names), F.struct(F.array(F.lit(build)).alias("build"), F.array(F.lit(test)).alias("test"))).otherwise(out)
    return out


def setup_for(language: Column) -> Column:
    """How a language is set up, as a map; other languages get a note that it is to be done by hand."""
    out = _map(NO_SETUP)
    for names, values in SETUP:
        out = F.when(F.lower(language).isin(*names), _map(values)).otherwise(out)
    return out


def build_tasks(changes: DataFrame, source: str) -> DataFrame:
    """Tasks of changes ``(repo, number, language, base_sha, merge_sha, title, body, diff)``.

    The diff is split into solution and tests and its lines are counted; the
    prompt is the original text until it is rewritten. Counts without a diff are 0.
    """
    parts, delta = split_diff(F.col("diff")), line_delta(F.coalesce("diff", F.lit("")))
    files = F.regexp_count(F.coalesce("diff", F.lit("")), F.lit(r"(?m)^diff --git "))
    text = original_text(F.col("repo"), F.col("number"), F.col("title"), F.col("body"))
    return changes.select(
        F.concat_ws("-", "repo", F.col("number").cast("string")).alias("id"),
        "repo",
        F.col("base_sha").alias("base_commit"),
        F.col("merge_sha").alias("merge_commit"),
        "language",
        parts["solution"].alias("patch"),
        parts["tests"].alias("test_patch"),
        text.alias("prompt"),
        text.alias("original_pr_body"),
        setup_for(F.coalesce("language", F.lit(""))).alias("install_config"),
        F.create_map(
            F.lit("files_changed"), files.cast("string"), F.lit("added_lines"), delta["added"].cast("string"),
            F.lit("removed_lines"), delta["removed"].cast("string"), F.lit("source"), F.lit(source),
        ).alias("meta"),
    )


def checks_of(fail_to_pass: Column, pass_to_pass: Column) -> Column:
    """The failing tests, then the passing ones; NULL lists are empty."""
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(fail_to_pass, none), F.coalesce(pass_to_pass, none))


def synthetic_tasks(tasks: DataFrame) -> DataFrame:
    """``id, level, tags, criteria, statement`` in the form of a task library; score 0 is easy, 1 and 2 medium, else hard."""
    s = F.col("difficulty_score")
    return tasks.select(
        "id",
        F.when(s == 0, "easy").when(s.isin(1, 2), "medium").otherwise("hard").alias("level"),
        F.array(F.concat(F.lit("language:"), F.lower("language")), F.concat(F.lit("repo:"), "repo")).alias("tags"),
        checks_of(F.col("fail_to_pass"), F.col("pass_to_pass")).alias("criteria"),
        F.col("prompt").alias("statement"),
    )


def handed_out(tasks: DataFrame, category: str | None = None, folder: str = "out") -> DataFrame:
    """``task_id, category, statement, label, tags, criteria, saved`` of the tasks that are handed out."""
    return tasks.select(
        F.col("id").alias("task_id"),
        F.lit(category or "swe-mining").alias("category"),
        F.col("prompt").alias("statement"),
        label_of(F.col("quality_score"), F.col("difficulty_score")).alias("label"),
        F.array(F.lit("swe"), F.concat(F.lit("language:"), F.lower("language")), F.concat(F.lit("repo:"), "repo")).alias("tags"),
        checks_of(F.col("fail_to_pass"), F.col("pass_to_pass")).alias("criteria"),
        F.coalesce("workspace_path", F.concat(F.lit(f"{folder}/"), "id")).alias("saved"),
    )


def triage_prompt(title: Column, body: Column, files: Column) -> Column:
    """What a model is asked about a change: its title, 1000 bytes of its body and 50 of its files."""
    from millrace.functions.text import truncate_bytes

    none = F.array().cast("array<string>")
    return F.concat(
        F.lit("Title: "), F.coalesce(title, F.lit("")), F.lit("\n\nDescription:\n"), truncate_bytes(F.coalesce(body, F.lit("")), 1000, "..."),
        F.lit("\n\nFiles:\n  "), F.array_join(F.slice(F.coalesce(files, none), 1, 50), "\n  "),
    )
