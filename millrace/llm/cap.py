"""Problem 5: at most so many rows per contributor, the best ones by score."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bisect import beyond, cutoffs
from millrace.runtime import fold, materialize

KEYS = ("rank_score", "rank_number", "rank_id")


def ranked(rows: DataFrame, contributor: str, score: str, tie: str, row_key: str) -> DataFrame:
    """The narrow columns the bisection reads. NULL and NaN scores and NULL ties come last."""
    s = F.col(score).cast("double")
    clamped = F.least(F.greatest(s, F.lit(0.0)), F.lit(1.0))
    return rows.select(
        F.coalesce(fold(contributor), F.lit("")).alias("contributor"),
        F.when(s.isNull() | F.isnan(s), F.lit(1.0)).otherwise(-clamped).alias("rank_score"),
        F.coalesce(F.col(tie).cast("bigint"), F.lit((1 << 62) - 1)).alias("rank_number"),
        F.coalesce(F.col(row_key).cast("bigint"), F.lit((1 << 63) - 1)).alias("rank_id"),
    )


def over_cap(
    rows: DataFrame,
    *,
    share: float | Fraction | None = None,
    max_rows: int | None = None,
    contributor: str = "repo",
    score: str = "quality_score",
    tie: str = "pr_number",
    row_key: str = "row_id",
) -> DataFrame:
    """The rows that a cap per contributor drops: ``contributor, rank_id``.

    The cap is ``max_rows``, or ``max(1, floor(share * rows))``. Contributors
    are compared trimmed and in lower case, NULL counts as the empty name.
    Scores are clamped to 0..1, NULL and NaN rank last; equal scores go by
    smaller ``tie``, then ``row_key``. An empty table drops nothing. Rows
    without a key come last and cannot be told apart, so :func:`cap_per_contributor` keeps them.

    Under a share s fewer than 1/s + 1 contributors can lie over the cap, so
    the bounds that each round joins stay that small whatever the data.
    """
    if (share is None) == (max_rows is None):
        raise ValueError("give either share or max_rows")
    narrow = ranked(rows, contributor, score, tie, row_key)
    counts = narrow.groupBy("contributor").agg(F.count("*").alias("rows"))
    if max_rows is None:
        total = narrow.count()
        max_rows = max(1, int(total * Fraction(share).limit_denominator(1_000_000)))
    quotas = counts.where(F.col("rows") > max_rows).select("contributor", F.lit(max_rows).cast("bigint").alias("quota"))
    # written, so that joins know how few contributors are left, and that rounds read only their rows
    quotas = materialize(quotas, "cap")
    over = materialize(narrow.join(quotas.select("contributor"), "contributor"), "cap")
    cuts = cutoffs(over, "contributor", KEYS, quotas)
    return over.join(cuts, "contributor").where(beyond(KEYS)).select("contributor", "rank_id")


def cap_per_contributor(rows: DataFrame, *, row_key: str = "row_id", **kw) -> DataFrame:
    """``rows`` without those that :func:`over_cap` drops."""
    gone = over_cap(rows, row_key=row_key, **kw).select(F.col("rank_id").alias(row_key))
    return rows.join(gone, row_key, "left_anti")
