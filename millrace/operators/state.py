"""Keyed state: merging partial updates, marks, and joins against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_log(log: DataFrame, keys: Sequence[str], seq: str, overwrite: Sequence[str] = ("status",)) -> DataFrame:
    """Fold a log of partial updates into one row per key.

    Each column keeps its latest non-NULL value by ``seq``; the ``overwrite``
    columns take the latest value even if NULL. ``first_seq`` and ``last_seq``
    tell when a key appeared and last changed. Updates are combined before the
    shuffle, so a hot key costs one partial row per task.
    """
    rest = [c for c in log.columns if c not in (*keys, seq)]
    aggs = [F.max_by(F.struct(F.col(c).alias("v")), F.col(seq))["v"].alias(c) if c in overwrite else _latest(c, seq) for c in rest]
    return log.groupBy(*keys).agg(*aggs, F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))


def _latest(c: str, seq: str) -> Column:
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c)


def upsert(state: DataFrame, changes: DataFrame, keys: Sequence[str], overwrite: Sequence[str] = ("status",)) -> DataFrame:
    """State after one batch of changes with unique keys: new values where given, else the old ones."""
    out = state.alias("o").join(changes.alias("n"), list(keys), "full")
    cols = [F.col(k) for k in keys]
    known = F.coalesce(*[F.col(f"n.{c}").isNotNull() for c in overwrite[:1]]) if overwrite else F.lit(False)
    for c in state.columns:
        if c in keys:
            continue
        if c in changes.columns:
            new = F.when(known, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if c in overwrite else F.coalesce(f"n.{c}", f"o.{c}")
            cols.append(new.alias(c))
        else:
            cols.append(F.col(f"o.{c}").alias(c))
    return out.select(cols)


def mark(state: DataFrame, marks: DataFrame, keys: Sequence[str], status: str, reason: str = "rejection_reason") -> DataFrame:
    """Set the status of the marked keys that exist; a reason replaces the old one only if given."""
    m = marks.select(*keys, F.col(reason).alias("_reason"), F.lit(True).alias("_hit")) if reason in marks.columns else marks.select(
        *keys, F.lit(None).cast("string").alias("_reason"), F.lit(True).alias("_hit")
    )
    out = state.join(m.dropDuplicates(list(keys)), list(keys), "left")
    cols = [
        F.when(F.col("_hit"), F.lit(status)).otherwise(F.col("status")).alias("status")
        if c == "status"
        else F.coalesce("_reason", reason).alias(reason)
        if c == reason
        else F.col(c)
        for c in state.columns
    ]
    return out.select(cols)


def not_in(rows: DataFrame, known: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows without a partner in ``known``; ``on`` maps row columns to columns of ``known``."""
    right = known.select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(on.values())])
    cond = None
    for i, left in enumerate(on):
        c = rows[left] == F.col(f"_k{i}")
        cond = c if cond is None else cond & c
    return rows.join(right, cond, "left_anti")


def overlay(rows: DataFrame, facts: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each of ``columns`` from ``facts`` where there is a value, else as it was."""
    f = facts.select(*keys, *[F.col(c).alias(f"_f_{c}") for c in columns])
    joined = rows.join(f, list(keys), "left")
    return joined.select([F.coalesce(f"_f_{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns])


def status_histogram(state: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """One row: total and a count per status."""
    return state.agg(
        F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in statuses]
    )


def first_seen(rows: DataFrame, key: Column, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``hit``: whether an earlier row has the same key; ``order`` tells rows of a key apart.

    The first row of each key is found before the shuffle, so a hot key is never gathered.
    """
    keyed = rows.withColumns({"_key": F.coalesce(key.cast("string"), F.lit("")), "_at": F.struct(*order)})
    first = keyed.groupBy("_key").agg(F.min("_at").alias("_first"))
    return keyed.join(first, "_key").withColumn("hit", F.col("_at") > F.col("_first")).drop("_key", "_at", "_first")
