"""Running sums and row numbers of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import materialize, sums_before


def running_sum(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` up to and including each row of its group.

    Rows are dealt by range of group and order, so a group spreads over as many
    tasks as it fills; sums of the ranges before are added to those inside. NULL
    is a group of its own. ``order`` must tell rows of a group apart, or ties
    are numbered at will.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumns({"_by": F.struct(*by) if by else F.lit(0), "_v": value})
    ranged = keyed.repartitionByRange(parts, "_by", *order).withColumn("_part", F.spark_partition_id().cast("bigint"))
    placed = materialize(ranged, "ranged")  # written, so that a row's range stays what it was
    held = placed.groupBy("_by", "_part").agg(F.sum("_v").alias("_sum"))
    starts = sums_before(held, ["_by"], "_part", "_sum", "_start").select("_by", "_part", "_start")
    w = Window.partitionBy("_by", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.withColumn("_own", F.sum("_v").over(w)).join(starts, ["_by", "_part"])
    return out.withColumn(name, F.col("_start") + F.col("_own")).select(*rows.columns, name)


def row_numbers(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``name``: the number of each row in its group, from 1."""
    return running_sum(rows, by, order, F.lit(1).cast("bigint"), name)
