"""Text functions, as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.paths import is_test_in_patch
from millrace.runtime import utrim

# Wordings that link a change to an issue, in the order they are looked for.
ISSUE_LINKS = (r"(?i)fixes\s+#(\d+)", r"(?i)close[s]?\s+#(\d+)", r"(?i)resolves\s+#(\d+)")
TEST_SUFFIXES = r"\.(?:py|ts|js|java|rs|go|rb|sh)$"


def issue_links(body: Column) -> Column:
    """The first issue number behind each wording, in the order of the wordings."""
    found = [F.regexp_extract(F.coalesce(body, F.lit("")), p, 1).try_cast("bigint") for p in ISSUE_LINKS]
    return F.array_compact(F.array(*found))


def strip_identifiers(text: Column, repo: Column, number: Column) -> Column:
    """Remove the repository, its name behind a slash, and the pull number in any spelling, in that order."""
    n = number.cast("string")
    out = F.replace(text, repo, F.lit(""))
    out = F.replace(out, F.concat(F.lit("/"), F.substring_index(repo, "/", -1)), F.lit(""))
    for head in ("#", "PR #", "PR ", "pull/"):
        out = F.replace(out, F.concat(F.lit(head), n), F.lit(""))
    return utrim(F.replace(out, F.lit("  "), F.lit(" ")))


def number_of_id(task_id: Column) -> Column:
    """The number behind the last dash, else 0."""
    tail = F.substring_index(task_id, "-", -1)
    return F.coalesce(F.when(tail.rlike(r"^\d+$"), tail.try_cast("bigint")), F.lit(0))


def command_paths(command: Column) -> Column:
    """Test files that a shell command names, dotted unittest modules as paths; no globs, no repeats."""
    tokens = F.transform(F.split(utrim(command), r"\s+"), lambda t: F.regexp_replace(t, r"^['\";]+|['\";]+$", ""))
    named = F.filter(tokens, lambda t: t.rlike(TEST_SUFFIXES) & ~t.rlike(r"[*?]"))
    dotted = F.transform(
        F.filter(tokens, lambda t: t.contains(".") & ~t.startswith("-") & ~t.contains("/")),
        lambda t: F.concat(F.replace(t, F.lit("."), F.lit("/")), F.lit(".py")),
    )
    modules = command.rlike(r"python3? -m unittest")
    return F.when(modules, F.concat(named, F.array_except(dotted, named))).otherwise(named)


def truncate_bytes(text: Column, limit: int, suffix: str = "") -> Column:
    """At most ``limit`` UTF-8 bytes of a text, cut before a character, never inside one."""
    raw = F.encode(text, "UTF-8")
    head = F.hex(F.substring(raw, 1, limit + 1))
    # drop the byte behind the limit, and with it the rest of the character it continues
    cut = F.regexp_replace(head, r"(?:(?:[C-F][0-9A-F])(?:[89AB][0-9A-F])*|[0-7][0-9A-F])$", "")
    kept = F.decode(F.unhex(cut), "UTF-8")
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.concat(kept, F.lit(suffix)))


# ------------------------------------------------------------------------ diffs
def diff_blocks(diff: Column) -> Column:
    """The file blocks of a unified diff as ``array<struct<path, text>>``; text before the first header is dropped."""
    parts = F.filter(F.split(diff, r"(?m)(?=^diff --git a/)"), lambda b: b.startswith("diff --git a/"))
    return F.transform(
        parts, lambda b: F.struct(F.regexp_extract(b, r"^diff --git a/(\S+)", 1).alias("path"), b.alias("text"))
    )


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once; higher-order functions share no subexpressions."""
    return F.element_at(F.transform(F.array(value), use), 1)


def split_diff(diff: Column) -> Column:
    """``struct<solution, tests>`` of a diff by the paths of its blocks.

    Without any block the whole text is the solution. A solution that is not
    empty ends with a line break.
    """
    sided = F.transform(
        diff_blocks(diff), lambda b: F.struct(b["text"].alias("text"), is_test_in_patch(b["path"]).alias("test"))
    )
    join = lambda blocks: F.array_join(F.transform(blocks, lambda b: b["text"]), "")
    both = _bind(
        sided,
        lambda bs: F.struct(join(F.filter(bs, lambda b: ~b["test"])).alias("s"), join(F.filter(bs, lambda b: b["test"])).alias("t")),
    )

    def close(x: Column) -> Column:
        none = (utrim(x["s"]) == "") & (utrim(x["t"]) == "")
        ended = F.when((x["s"] != "") & ~x["s"].endswith("\n"), F.concat(x["s"], F.lit("\n"))).otherwise(x["s"])
        return F.struct(F.when(none, diff).otherwise(ended).alias("solution"), x["t"].alias("tests"))

    return F.when(diff.isNotNull(), _bind(both, close))


def line_delta(diff: Column) -> Column:
    """``struct<added, removed>`` lines, file headers aside."""
    return F.struct(
        F.regexp_count(diff, F.lit(r"(?m)^\+(?!\+\+)")).cast("bigint").alias("added"),
        F.regexp_count(diff, F.lit(r"(?m)^-(?!--)")).cast("bigint").alias("removed"),
    )
