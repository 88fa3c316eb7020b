"""Session helpers shared by all operators: table access, lineage cuts, Unicode trimming."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir`` (a file or a directory of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, as the session resolves it, and the path in its form."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the session uses."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def listing(spark: SparkSession, path: str) -> list[str]:
    """The full paths right below a folder, by name; none if it does not exist."""
    fs, p = _hadoop(spark, path)
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(p)) if fs.exists(p) else []


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, so that executors reach what the driver means."""
    fs, p = _hadoop(spark, path)
    return str(fs.makeQualified(p).toString())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the session leaves it unset and runs in one process (tests) a
    temporary folder takes its place; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_RUN = f"millrace-{uuid.uuid4().hex}"  # the folder of this process inside the shared one


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    A written table survives the loss of any executor, is columnar and
    compressed, and gives later joins true sizes to plan with. It lives until
    :func:`release`, as results are read lazily.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{_RUN}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete everything this process has materialised; results that still read it must be written first."""
    fs, p = _hadoop(spark, f"{shared_dir(spark)}/{_RUN}")
    fs.delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan that has fewer tasks than there are slots to all of them, before a pass that is bound by CPU.

    A table of a few files that do not split is read by as few tasks. Scans with tasks enough stay as they are.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


BLOCK = 1024


def sums_before(df: DataFrame, groups: Sequence[str], index: str, value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of its group with a smaller ``index``.

    ``index`` is a whole number, unique in its group. Sums go in two steps, over blocks of ``BLOCK`` indexes and inside
    each, so that a task holds a block, or one row per block, but never a group.
    """
    block = F.floor(F.col(index) / BLOCK).cast("bigint")
    per = df.groupBy(*groups, block.alias("_block")).agg(F.sum(value).alias("_held"))
    whole = Window.partitionBy(*(groups or [F.lit(1)])).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per.select(*groups, "_block", F.coalesce(F.sum("_held").over(whole), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy(*groups, "_block").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    own = df.withColumn("_block", block).withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return own.join(ahead, [*groups, "_block"]).withColumn(name, F.col("_ahead") + F.col("_own")).drop("_block", "_own", "_ahead")


def utrim(c: Column | str) -> Column:
    """Trim all Unicode white space (``trim`` strips spaces only)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def fold(c: Column | str) -> Column:
    """The form in which repositories and categories are compared: trimmed, lower case."""
    return F.lower(utrim(c))
