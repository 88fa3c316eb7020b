"""Writing datasets: the export projection, shards, splits and task folders."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from millrace.functions.scalars import score_of_level
from millrace.functions.text import number_of_id
from millrace.operators.selection import dedupe_basenames, number_shards
from millrace.runtime import materialize, qualified
from millrace.sources.tables import EXPORT, require_rows


def _null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def export_projection(tasks: DataFrame) -> DataFrame:
    """Tasks as the 16 columns of the exported dataset, in their order. A score that is no number is NULL."""
    level = F.coalesce(
        F.col("meta")["difficulty"],
        F.when(F.col("difficulty_score") <= 1, "easy").when(F.col("difficulty_score") == 2, "medium").otherwise("hard"),
    )
    values = {
        "instance_id": F.col("id"),
        "repo": F.col("repo"),
        "base_commit": F.col("base_commit"),
        "patch": F.col("patch"),
        "test_patch": _null_if_empty(F.col("test_patch")),
        "problem_statement": F.col("prompt"),
        "hints_text": _null_if_empty(F.col("original_pr_body")),
        "created_at": F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"),
        "version": _null_if_empty(F.col("meta")["version"]),
        "fail_to_pass": F.to_json("fail_to_pass"),
        "pass_to_pass": F.to_json("pass_to_pass"),
        "environment_setup_commit": _null_if_empty(F.col("meta")["environment_setup_commit"]),
        "language": F.col("language"),
        "difficulty": level,
        "difficulty_score": F.col("difficulty_score").cast("smallint"),
        "quality_score": F.nanvl("quality_score", F.lit(None).cast("double")),
    }
    return tasks.select(*[values[f.name].alias(f.name) for f in EXPORT.fields])


def write_parquet(rows: DataFrame, path: str) -> None:
    """One Parquet table, zstd; nothing to write is an error."""
    require_rows(rows).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_shards(rows: DataFrame, path: str, size: int = 50, order: tuple[str, ...] = ("instance_id",), *, start: int | None = None) -> None:
    """``path/shard=n`` folders of ``size`` rows each.

    Older shards are replaced, or with ``start`` kept: the new ones are numbered from there and added.
    """
    placed = number_shards(rows, size, list(order)).withColumn("shard", F.col("shard") + F.lit(start or 0))
    mode = "overwrite" if start is None else "append"
    placed.write.mode(mode).partitionBy("shard").option("compression", "zstd").parquet(path)


def finalize(rows: DataFrame, path: str) -> DataFrame:
    """Write the whole set as ``train.parquet`` and a ``{level}.parquet`` per difficulty; returns rows per difficulty.

    There are as many difficulties as the data has names for them, a handful, so they are written one after the other.
    """
    level = F.coalesce("difficulty", F.lit("unknown"))
    kept = materialize(require_rows(rows), "final")
    write_parquet(kept, posixpath.join(path, "train.parquet"))
    counted = kept.groupBy(level.alias("difficulty")).agg(F.count("*").alias("n"))
    for r in counted.collect():
        write_parquet(kept.where(level == r["difficulty"]), posixpath.join(path, f"{r['difficulty']}.parquet"))
    return counted


def _scripts(commands: Column, name: str, note: str) -> Column:
    """One shell script per command, numbered from 1."""
    return F.transform(
        F.coalesce(commands, F.array().cast("array<string>")),
        lambda c, i: F.struct(
            F.concat(F.lit(f"tests/{name}_"), (i + 1).cast("string"), F.lit(".sh")).alias("path"),
            F.concat(F.lit(f"#!/bin/bash\n# {note}\n"), c, F.lit("\n")).alias("content"),
        ),
    )


def task_files(tasks: DataFrame) -> DataFrame:
    """``task_id, path, content`` of every file of a task folder.

    The prompt, the original text if there is one, the task itself as YAML (of
    which JSON is a part), the tests under distinct names, a script per command, and
    ``checks.txt`` (failing then passing commands, if there are failing ones).
    """
    tests = F.from_json(F.col("meta")["test_files"], "array<struct<path:string,content:string>>")
    files = tasks.select(F.col("id").alias("task_id"), F.posexplode(tests).alias("pos", "f")).select(
        "task_id", "pos", "f.path", "f.content"
    )
    named = dedupe_basenames(files).select("task_id", F.concat(F.lit("tests/"), "name").alias("path"), "content")
    none = F.array().cast("array<string>")
    checks = F.when(F.size("fail_to_pass") > 0, F.array_join(F.concat("fail_to_pass", F.coalesce("pass_to_pass", none)), "\n"))
    page = lambda mark, c: F.concat(F.lit("# "), "id", F.lit(f"{mark}\n\n"), c, F.lit("\n"))
    original = F.when(F.coalesce("original_pr_body", F.lit("")) != "", page(" (original PR)", F.col("original_pr_body")))
    texts = F.array(
        F.struct(F.lit("prompt.md").alias("path"), page("", F.coalesce("prompt", F.lit(""))).alias("content")),
        F.struct(F.lit("original_pr.md").alias("path"), original.alias("content")),
        F.struct(F.lit("workspace.yaml").alias("path"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in tasks.columns])).alias("content")),
        F.struct(F.lit("checks.txt").alias("path"), checks.alias("content")),
    )
    scripts = F.concat(
        _scripts(F.col("fail_to_pass"), "fail_to_pass", "This test must FAIL on base commit, PASS after fix"),
        _scripts(F.col("pass_to_pass"), "pass_to_pass", "This test must PASS on base commit AND after fix"),
    )
    fixed = tasks.select(F.col("id").alias("task_id"), F.explode(F.concat(texts, scripts)).alias("f")).select("task_id", "f.*")
    return fixed.where("content is not null").unionByName(named)


def write_files(files: DataFrame, root: str) -> None:
    """Write rows ``(folder, path, content)`` as files below ``root``, from the executors, to the file system that ``root`` names."""
    target = qualified(files.sparkSession, root)

    def write(rows: Iterator[Row]) -> None:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(target)
        for r in rows:
            path = posixpath.join(base, r["folder"], r["path"])
            system.create_dir(posixpath.dirname(path), recursive=True)
            with system.open_output_stream(path) as f:
                f.write(r["content"].encode("utf-8"))

    if target.startswith("file:") and not files.sparkSession.sparkContext.master.startswith("local"):
        raise ValueError(f"{target} is on the disk of each machine")
    files.select("folder", "path", "content").foreachPartition(write)


def write_task_folders(tasks: DataFrame, root: str) -> None:
    """Write :func:`task_files` below ``root``, a folder per task."""
    write_files(task_files(tasks).withColumnRenamed("task_id", "folder"), root)


KEPT = ("workspace.yaml", "prompt.md", "checks.txt")


def reexport(spark, source: str, target: str, names: tuple[str, ...] = KEPT) -> DataFrame:
    """Copy the named files of every task folder; ``folder, copied, skipped`` tell how many there were and how many not."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    base = F.substring_index("path", "/", -1)
    root = qualified(spark, source).rstrip("/").split(":")[-1].lstrip("/")
    inside = F.regexp_replace(F.regexp_replace("path", r"^\w+:/+", ""), F.lit("^" + root.replace(".", r"\.") + "/"), F.lit(""))
    rows = found.where(base.isin(*names)).select(
        F.regexp_replace(inside, r"/[^/]*$", "").alias("folder"), base.alias("path"), F.decode("content", "UTF-8").alias("content")
    )
    rows = materialize(rows, "reexport")
    write_files(rows, target)
    return rows.groupBy("folder").agg(F.count("*").alias("copied")).withColumn("skipped", F.lit(len(names)) - F.col("copied"))


def processed_lines(tasks: DataFrame) -> DataFrame:
    """Skip-list lines ``{"repo":…,"pr":…}`` of finished tasks."""
    return tasks.select(F.to_json(F.struct("repo", number_of_id(F.col("id")).alias("pr"))).alias("value"))


def report_lines(rows: DataFrame) -> DataFrame:
    """Rows of a report as JSON text, NULL fields kept; write with ``write.text``."""
    return rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"}).alias("value"))


def unpublished(folders: DataFrame, published: DataFrame) -> DataFrame:
    """Finished folders ``(task_id, done)`` that no marker ``(task_id)`` names yet."""
    return folders.where("done").join(published.select("task_id").distinct(), "task_id", "left_anti")


def scored_levels(rows: DataFrame) -> DataFrame:
    """``difficulty_score`` of each row from the name of its difficulty."""
    return rows.withColumn("difficulty_score", score_of_level(F.lower("difficulty")).cast("smallint"))


def summary(rows: DataFrame, shard_size: int = 50) -> DataFrame:
    """One row: rows, shards, and rows per difficulty as a map."""
    per = rows.groupBy(F.coalesce("difficulty", F.lit("unknown")).alias("k")).agg(F.count("*").alias("n"))
    return per.agg(
        F.sum("n").alias("total"),
        F.ceil(F.sum("n") / shard_size).cast("bigint").alias("shards"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "n")))).alias("by_difficulty"),
    )


def card(rows: DataFrame, name: str, *, licence: str = "", tags: tuple[str, ...] = ()) -> str:
    """A dataset card: front matter with the configurations, and a table of the fields."""
    fields = "\n".join(f"| `{f.name}` | {f.dataType.simpleString()} | {'yes' if f.nullable else 'no'} |" for f in rows.schema.fields)
    head = [f"name: {name}", *([f"license: {licence}"] if licence else []), *([f"tags: [{', '.join(tags)}]"] if tags else [])]
    splits = ["configs:", "- config_name: default", "  data_files:", "  - split: train", "    path: train.parquet"]
    front = "\n".join([*head, *splits])
    return f"---\n{front}\n---\n\n# {name}\n\n| field | type | may be null |\n|---|---|---|\n{fields}\n"
