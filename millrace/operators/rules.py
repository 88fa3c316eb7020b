"""Filters that say why: candidates, rules with reasons and a score, gates by level."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import paths
from millrace.operators.selection import take_quotas
from millrace.runtime import utrim

DEFAULT_TITLE = "Untitled change"


def is_bot(actor: Column) -> Column:
    return actor.contains("[bot]") | (actor == "dependabot")


def candidates(events: DataFrame) -> DataFrame:
    """Events of merged pull requests with a number, by people, in an organisation. NULL fails each of these."""
    return events.where(
        (F.lower("action") == "merged") & (F.col("pull_number") != 0) & ~is_bot(F.col("actor")) & F.col("has_org")
    )


def with_code_changes(rows: DataFrame) -> DataFrame:
    """Rows whose title and merge commit are known and that change lines of files."""
    known = (F.col("title") != DEFAULT_TITLE) & (F.col("merge_sha") != "")
    return rows.where(known & (F.col("files_changed") > 0) & ((F.col("added_lines") > 0) | (F.col("removed_lines") > 0)))


@dataclass(frozen=True)
class Rule:
    """A rule: when it is broken, the words for it, and what it takes off the score."""

    broken: Column
    reason: Column
    penalty: float


def rule_filter(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rows`` with ``accepted``, ``reasons`` (of all broken rules, in order) and ``score``.

    A rule whose condition is NULL is kept. The score is 1 less the penalties,
    within 0 and 1; a row is accepted if no rule is broken.
    """
    broken = [F.coalesce(r.broken, F.lit(False)) for r in rules]
    reasons = F.array_compact(F.array(*[F.when(b, r.reason) for b, r in zip(broken, rules)]))
    lost = sum([F.when(b, F.lit(r.penalty)).otherwise(0.0) for b, r in zip(broken, rules)], F.lit(0.0))
    out = rows.withColumn("reasons", reasons.cast("array<string>"))
    return out.withColumns(
        {"accepted": F.size("reasons") == 0, "score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(1.0 - lost, 6)))}
    )


def change_rules(
    *, languages: Sequence[str], min_stars: int, max_files: int, min_lines: int, max_lines: int, min_description: int,
    penalties: Mapping[str, float],
) -> list[Rule]:
    """The rules on a change: its language, stars, size, kind of files and description.

    Rows have ``language, stars, files_changed, added_lines, changed_files,
    title, body``. Unknown languages, 0 stars and 0 lines pass, as nothing is
    known then; lists of files are judged only if there are any. Thresholds and
    penalties are the caller's.
    """
    language = F.lower(F.coalesce("language", F.lit("")))
    named = ~language.isin("", "unknown", "null")
    stars, files, added = F.col("stars"), F.col("files_changed"), F.col("added_lines")
    changed = F.coalesce("changed_files", F.array().cast("array<string>"))
    length = sum((F.octet_length(utrim(F.coalesce(c, F.lit("")))) for c in ("title", "body")), F.lit(0))
    text = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in xs])
    p = penalties
    return [
        Rule(named & ~language.isin([x.lower() for x in languages]) if languages else F.lit(False), text("language not listed: ", F.col("language")), p["language"]),
        Rule((stars > 0) & (stars < min_stars), text("stars below: ", stars), p["stars"]),
        Rule(files > max_files, text("files above: ", files), p["files"]),
        Rule((added > 0) & (added < min_lines), text("lines below: ", added), p["lines"]),
        Rule(added > max_lines, text("lines above: ", added), p["lines"]),
        Rule(paths.all_of(changed, paths.is_doc), F.lit("all files are documentation"), p["docs"]),
        Rule(paths.all_of(changed, paths.is_test), F.lit("all files are tests"), p["tests"]),
        Rule(length < min_description, text("description too short: ", length), p["description"]),
        Rule((F.size(changed) > 0) & ~paths.has_build(changed), F.lit("no build files"), p["build"]),
    ]


def level_gate(
    rows: DataFrame, level: Column, order: Sequence[Column | str], *, only: str | None = None, quotas: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows whose level is asked for: of one level, or the first of each level up to its quota. Rows without a level pass."""
    if quotas is not None:
        known = take_quotas(rows.where(level.isNotNull()), quotas, level, order)
        return known.unionByName(rows.where(level.isNull()))
    return rows.where(level.isNull() | (level == only)) if only is not None else rows


def first_rows(rows: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` rows over all; each task hands on no more than ``n``."""
    return rows.orderBy(*order).limit(n)
