"""Parallel bisection: the cutoffs of the best n rows of every group at once.

Each group carries bounds on its cutoff. A round counts, for all groups
together, the rows between successive probe points inside the bounds (one
aggregation whose partial sums are combined before the shuffle), then narrows
every group's bounds to the values seen in the interval that holds its cutoff.
Rows never move and no group is ever sorted, so a group with a third of all
rows costs no more than the same rows spread over many groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import materialize

PROBES = 512


def cutoffs(rows: DataFrame, group: str, keys: Sequence[str], quotas: DataFrame) -> DataFrame:
    """Per group of ``quotas(group, quota)`` the key of its last row to keep.

    Rows count by ascending ``keys`` (numeric, not NULL);
    later keys resolve ties of earlier ones. Groups with no more rows than
    their quota, and quotas below 1, are not returned. Gives
    ``group, cut_0, cut_1, ...``, NULL where an earlier key decides alone; rows
    equal in all keys stay or go together.
    """
    cuts = [f"cut_{i}" for i in range(len(keys))]
    state = (
        rows.join(quotas, group)
        .groupBy(group)
        .agg(F.max("quota").alias("need"), F.count("*").alias("n"), *_bounds(keys[0]))
        .where("n > need and need > 0")
    )
    parts: list[DataFrame] = []
    for level, key in enumerate(keys):
        found = _one_key(rows, group, key, dict(zip(keys[:level], cuts)), cuts[level], materialize(state, "bisect"))
        if found is None:
            break
        last = level + 1 == len(keys)
        decided = found if last else found.where("n = need")
        for i in range(level + 1, len(keys)):
            decided = decided.withColumn(cuts[i], F.lit(None).cast(rows.schema[keys[i]].dataType))
        parts.append(decided.select(group, *cuts))
        if last:
            break
        tied = rows.join(found.where("n > need").drop("n"), group).where(_at(dict(zip(keys, cuts[: level + 1]))))
        state = tied.groupBy(group, "need", *cuts[: level + 1]).agg(F.count("*").alias("n"), *_bounds(keys[level + 1]))
    if not parts:
        return rows.limit(0).select(group, *[F.col(k).alias(c) for k, c in zip(keys, cuts)])
    return reduce(DataFrame.unionByName, parts)


def _bounds(key: str) -> list[Column]:
    return [F.min(key).alias("lo"), F.max(key).alias("hi")]


def _gap(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_subtract(a, b).cast("double"), a.cast("double") - b.cast("double"))


def _at(fixed: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(c) for k, c in fixed.items()], F.lit(True))


def _one_key(
    rows: DataFrame, group: str, key: str, fixed: dict[str, str], cut: str, state: DataFrame
) -> DataFrame | None:
    """Bisect on one key. ``state``: group, need, earlier cuts, n, lo, hi; None if it is empty."""
    by_probe = Window.partitionBy(group).orderBy("probe")
    earlier = list(fixed.values())
    settled: list[DataFrame] = []
    while not state.isEmpty():
        settled.append(state.where("lo = hi").select(group, "need", *earlier, "n", F.col("lo").alias(cut)))
        open_ = state.where("lo < hi")
        inside = rows.join(open_.drop("n"), group).where(F.col(key).between(F.col("lo"), F.col("hi")) & _at(fixed))
        # differences before casts: large integers lose their last digits as doubles. The
        # lowest key has probe 0 and the highest PROBES, so every round narrows the bounds.
        probe = F.floor(_gap(F.col(key), F.col("lo")) / _gap(F.col("hi"), F.col("lo")) * F.lit(float(PROBES)))
        counted = inside.groupBy(group, "need", *earlier, probe.alias("probe")).agg(
            F.count("*").alias("n"), *_bounds(key)
        )
        holds = (F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))
        narrowed = (
            counted.withColumn("upto", F.sum("n").over(by_probe))
            .where(holds)
            .select(group, (F.col("need") - F.col("upto") + F.col("n")).alias("need"), *earlier, "n", "lo", "hi")
        )
        state = materialize(narrowed, "bisect")
    return reduce(DataFrame.unionByName, settled) if settled else None


def beyond(keys: Sequence[str]) -> Column:
    """True for rows after their group's cutoff; rows of groups without one are False."""
    after, equal = F.lit(False), F.lit(True)
    for i, k in enumerate(keys):
        cut = F.col(f"cut_{i}")
        after = after | (equal & cut.isNotNull() & (F.col(k) > cut))
        equal = equal & cut.isNotNull() & (F.col(k) == cut)
    return F.coalesce(after, F.lit(False))
