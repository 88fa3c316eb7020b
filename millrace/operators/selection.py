"""Selecting, numbering and sampling rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.running import row_numbers

LEVELS = ("easy", "medium", "hard")


def parse_quotas(text: str) -> dict[str, int]:
    """``level:count,…`` with blanks anywhere; of a repeated level the last counts. Errors name the part."""
    out: dict[str, int] = {}
    for part in text.split(","):
        level, sep, count = part.strip().partition(":")
        level = level.strip().lower()
        if not sep:
            raise ValueError(f"not level:count: {part.strip()!r}")
        if level not in LEVELS:
            raise ValueError(f"unknown level: {level!r}")
        if not count.strip().isdigit():
            raise ValueError(f"not a count: {count.strip()!r}")
        out[level] = int(count)
    return out


def parse_list(text: str) -> list[str]:
    """Comma-separated names, trimmed, in lower case, empty ones dropped."""
    return [x.strip().lower() for x in text.split(",") if x.strip()]


def take_quotas(rows: DataFrame, quotas: Mapping[str, int], level: Column, order: Sequence[Column | str]) -> DataFrame:
    """The first rows of each level up to its quota; other levels none.

    The rank is limited inside the window, so only quota rows of a task leave it.
    """
    quota = F.coalesce(*[F.when(level == k, F.lit(v)) for k, v in quotas.items()], F.lit(0))
    w = Window.partitionBy("_level").orderBy(*order)
    ranked = rows.withColumn("_level", level).withColumn("_quota", quota).where("_quota > 0")
    limit = max(quotas.values(), default=0)
    ranked = ranked.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit)
    return ranked.where("_rank <= _quota").drop("_level", "_quota", "_rank")


def take_quota_table(rows: DataFrame, quotas: DataFrame, level: Column, order: Sequence[Column | str]) -> DataFrame:
    """As :func:`take_quotas`, with the quotas as a table ``(level, quota)`` of the few levels there are; others none."""
    q = quotas.groupBy(F.col("level").alias("_level")).agg(F.max("quota").alias("_quota")).where("_quota > 0")
    joined = rows.withColumn("_level", level).join(F.broadcast(q.limit(MOST_LEVELS)), "_level")
    w = Window.partitionBy("_level").orderBy(*order)
    limit = q.agg(F.coalesce(F.max("_quota"), F.lit(0))).first()[0]
    ranked = joined.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit)
    return ranked.where("_rank <= _quota").drop("_level", "_quota", "_rank")


MOST_LEVELS = 1000  # rows of a quota table; levels are names that people give


def quota_progress(rows: DataFrame, quotas: Mapping[str, int], level: Column) -> DataFrame:
    """``level, quota, taken, complete`` for every level with a quota."""
    spark = rows.sparkSession
    q = spark.createDataFrame(list(quotas.items()), "level string, quota bigint")
    counted = rows.groupBy(level.alias("level")).agg(F.count("*").alias("n"))
    taken = F.coalesce("n", F.lit(0))
    return q.join(counted, "level", "left").select(
        "level", "quota", F.least(taken, F.col("quota")).alias("taken"), (taken >= F.col("quota")).alias("complete")
    )


def seeded_sample(rows: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their keys; equal runs draw equal rows."""
    return rows.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)


def number_shards(rows: DataFrame, size: int, order: Sequence[str]) -> DataFrame:
    """``shard`` (from 0) of every row, ``size`` rows each in the given order; no task ever sorts the whole table."""
    placed = row_numbers(rows, [], order, "_rn")
    return placed.withColumn("shard", F.floor((F.col("_rn") - 1) / size).cast("bigint")).drop("_rn")


def round_robin(rows: DataFrame, names: Sequence[str], order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``model`` of each row: the n-th of all rows, or of each group, goes to name n mod k."""
    numbered = row_numbers(rows, by, order, "_rn")
    pick = F.element_at(F.array(*[F.lit(n) for n in names]), ((F.col("_rn") - 1) % len(names) + 1).cast("int"))
    return numbered.withColumn("model", pick).drop("_rn")


def ab_arm(rows: DataFrame, ratio: float, order: Sequence[str], by: Sequence[str] = (), *, registered: bool = True) -> DataFrame:
    """``arm``: treatment for the first ``floor(100 * ratio)`` of every hundred rows, of all or of a group; control if the treatment is not registered."""
    n = (F.col("_rn") - 1) % 100
    arm = F.when((n < int(ratio * 100)) & F.lit(registered), "treatment").otherwise("control")
    return row_numbers(rows, by, order, "_rn").withColumn("arm", arm).drop("_rn")


def dedupe_basenames(paths: DataFrame, task: str = "task_id", pos: str = "pos", path: str = "path") -> DataFrame:
    """``name`` of each file in its task: the base name, with the position before it if an earlier file has it."""
    base = F.substring_index(F.col(path), "/", -1)
    w = Window.partitionBy(task, "_base").orderBy(pos)
    named = paths.withColumn("_base", base).withColumn("_rn", F.row_number().over(w))
    return named.withColumn(
        "name", F.when(F.col("_rn") == 1, F.col("_base")).otherwise(F.concat(F.col(pos).cast("string"), F.lit("_"), "_base"))
    ).drop("_base", "_rn")


def merge_files(first: Column, second: Column) -> Column:
    """Two lists of ``struct<path, content>``; of equal paths the first list's stays."""
    return F.concat(first, F.filter(second, lambda f: ~F.exists(first, lambda g: g["path"] == f["path"])))
