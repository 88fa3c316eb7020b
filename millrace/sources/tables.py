"""Dataset tables, skip lists and task folders."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.runtime import exists, is_file, listing

EXPORT = T.StructType(
    [
        T.StructField("instance_id", T.StringType()),
        T.StructField("repo", T.StringType()),
        T.StructField("base_commit", T.StringType()),
        T.StructField("patch", T.StringType()),
        T.StructField("test_patch", T.StringType()),
        T.StructField("problem_statement", T.StringType()),
        T.StructField("hints_text", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("fail_to_pass", T.StringType()),
        T.StructField("pass_to_pass", T.StringType()),
        T.StructField("environment_setup_commit", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("difficulty", T.StringType()),
        T.StructField("difficulty_score", T.ShortType()),
        T.StructField("quality_score", T.DoubleType()),
    ]
)


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` by name in the shape of ``schema``; missing columns and those of another kind are NULL."""
    have = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        got = have.get(f.name.lower())
        ok = got is not None and (isinstance(got.dataType, T.StringType) == isinstance(f.dataType, T.StringType))
        cols.append((F.col(f"`{got.name}`").try_cast(f.dataType) if ok else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(cols)


def string_list(c: Column) -> Column:
    """A JSON list of strings; anything else is the empty list."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def locate_dataset(spark: SparkSession, path: str, split: str | None = None) -> list[str]:
    """A file itself; in a folder the split (or train) file, else all Parquet files by name.

    A folder of parts is a table. Paths are those of the session's file systems.
    """
    inside = [] if is_file(spark, path) else listing(spark, path)
    name = lambda p: p.rstrip("/").rpartition("/")[2]
    if not inside or any(name(p).startswith("part-") for p in inside):
        return [path]
    single = [p for p in inside if name(p) == f"{split or 'train'}.parquet"]
    return single or [p for p in inside if name(p).endswith(".parquet")]


def dataset_tasks(rows: DataFrame) -> DataFrame:
    """Exported rows as tasks: lists parsed, NULL score 1, rows without id or repository dropped."""
    r = with_columns_of(rows, EXPORT)
    return r.where("coalesce(instance_id, '') != '' and coalesce(repo, '') != ''").select(
        F.col("instance_id").alias("id"),
        "repo",
        F.coalesce("base_commit", F.lit("")).alias("base_commit"),
        F.coalesce("language", F.lit("")).alias("language"),
        F.coalesce("difficulty_score", F.lit(1)).cast("smallint").alias("difficulty_score"),
        F.coalesce(F.col("created_at").try_cast("timestamp"), F.current_timestamp()).alias("created_at"),
        F.coalesce("patch", F.lit("")).alias("patch"),
        F.coalesce("test_patch", F.lit("")).alias("test_patch"),
        string_list(F.col("fail_to_pass")).alias("fail_to_pass"),
        string_list(F.col("pass_to_pass")).alias("pass_to_pass"),
        F.coalesce("problem_statement", F.lit("")).alias("prompt"),
        F.coalesce("hints_text", F.lit("")).alias("original_pr_body"),
        "quality_score",
        F.lit(True).alias("quality_passed"),
        F.lit("exported").alias("status"),
    )


def read_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    return dataset_tasks(spark.read.parquet(*locate_dataset(spark, path, split)))


def read_skip_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``repo, pr`` of a JSON-lines skip list; bad lines are ignored, no file means none."""
    schema = "repo string, pr bigint"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path).dropna().distinct()


def read_yaml(spark: SparkSession, root: str, name: str = "workspace.yaml", *, recursive: bool = True) -> DataFrame:
    """``path, json`` of every YAML file of that name below ``root``; files that do not parse are dropped.

    Without ``recursive`` only the folders right below ``root`` are looked into.
    """

    @F.pandas_udf("string")
    def parse(raw: pd.Series) -> pd.Series:
        import yaml

        def one(x: bytes) -> str | None:
            try:
                got = yaml.safe_load(bytes(x).decode("utf-8"))
            except (yaml.YAMLError, UnicodeDecodeError):
                return None
            return json.dumps(got, default=str) if isinstance(got, dict) else None

        return raw.map(one)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root)
    if not recursive:
        depth = len([x for x in root.split("://")[-1].rstrip("/").split("/") if x])
        local = F.regexp_replace("path", r"^\w+:/+", "")
        files = files.where(F.size(F.split(local, "/")) == depth + 2)
    return files.select("path", parse("content").alias("json")).where("json is not null")


def read_task_files(spark: SparkSession, root: str) -> DataFrame:
    """``id, category, difficulty, statement, criteria`` of every ``task.yaml`` one level below ``root``; missing parts are empty."""
    v = F.try_parse_json("json")
    get = lambda p, kind="string": F.try_variant_get(v, p, kind)
    return read_yaml(spark, root, "task.yaml", recursive=False).select(
        F.coalesce(get("$.id"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)).alias("id"),
        F.coalesce(get("$.category"), F.lit("")).alias("category"),
        F.coalesce(get("$.difficulty"), F.lit("medium")).alias("difficulty"),
        F.coalesce(get("$.problem_statement"), F.lit("")).alias("statement"),
        F.coalesce(get("$.success_criteria", "array<string>"), F.array().cast("array<string>")).alias("criteria"),
    )


def read_verification(spark: SparkSession, root: str, name: str = "task.yaml") -> tuple[DataFrame, DataFrame]:
    """The checks ``(path, kind, target, expected, required)`` and credits ``(path, criterion, points, file, pattern)`` of task files.

    Both lists are empty by default; checks are required unless they say otherwise.
    """
    files = read_yaml(spark, root, name).select("path", F.try_parse_json("json").alias("v"))
    part = lambda p: F.explode(F.coalesce(F.try_variant_get("v", p, "array<variant>"), F.array().cast("array<variant>")))
    get = lambda p, kind="string": F.try_variant_get("x", p, kind)
    checks = files.select("path", part("$.verification.automated_checks").alias("x")).select(
        "path", get("$.type").alias("kind"), get("$.target").alias("target"), get("$.expected").alias("expected"),
        F.coalesce(get("$.required", "boolean"), F.lit(True)).alias("required"),
    )
    credits = files.select("path", part("$.verification.partial_credit_criteria").alias("x")).select(
        "path", get("$.criterion").alias("criterion"), F.coalesce(get("$.points", "double"), F.lit(0.0)).alias("points"),
        get("$.file").alias("file"), get("$.pattern").alias("pattern"),
    )
    return checks, credits


def find_in_files(files: DataFrame, pattern: str, limit: int = 2000) -> DataFrame:
    """``path, line_no, line`` of the lines that match, by path and number, at most ``limit``."""
    lines = files.select("path", F.posexplode(F.split("content", "\n")).alias("pos", "line"))
    hits = lines.where(F.col("line").rlike(pattern)).select("path", (F.col("pos") + 1).alias("line_no"), "line")
    return hits.orderBy("path", "line_no").limit(limit)


def page_of(files: DataFrame, offset: int, count: int) -> DataFrame:
    """Numbered lines ``offset+1 .. offset+count`` of each file."""
    lines = files.select("path", F.posexplode(F.slice(F.split("content", "\n"), offset + 1, count)).alias("pos", "line"))
    return lines.select("path", (F.col("pos") + offset + 1).alias("line_no"), "line")


def require_rows(df: DataFrame) -> DataFrame:
    """``df``, or an error if it is empty."""
    if df.isEmpty():
        raise ValueError("nothing to write")
    return df


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union by name; columns that a part lacks are NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
