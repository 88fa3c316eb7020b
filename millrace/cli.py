"""Commands over stored tables: ``python -m millrace COMMAND ...``; each prints one JSON object.

Every command is a plan over Parquet tables. What models, containers and
services say comes in as tables of facts.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import outcomes, reports, rules, selection, state
from millrace.plans import dataset
from millrace.plans import tasks as plans
from millrace.runtime import fold, materialize
from millrace.sources import tables


def _rows(df: DataFrame) -> list[dict]:
    """The few rows of a summary."""
    return [json.loads(r[0]) for r in dataset.report_lines(df).collect()]


def _selected(args: argparse.Namespace, spark: SparkSession) -> DataFrame:
    """Tasks of merged changes with code, without those already done, up to a number or to quotas."""
    rows = rules.with_code_changes(spark.read.parquet(args.changes))
    rows = rows.withColumn("_repo", fold("repository"))
    if args.skip:
        done = tables.read_skip_list(spark, args.skip).select(fold("repo").alias("repo"), "pr")
        rows = state.not_in(rows, done, {"_repo": "repo", "number": "pr"})
    order = [F.xxhash64(F.lit(args.seed), "_repo", "number"), "_repo", "number"]
    if args.quotas:
        level = F.col("metadata")["difficulty"]
        rows = rules.level_gate(rows, level, order, quotas=selection.parse_quotas(args.quotas))
    else:
        rows = rules.first_rows(rows, args.count, order)
    diffs = spark.read.parquet(args.diffs).select(fold("repo").alias("_r"), F.col("pr_number").alias("_n"), F.col("patch").alias("diff"))
    return rows.join(diffs, (F.col("_repo") == F.col("_r")) & (F.col("number") == F.col("_n"))).select(
        F.col("repository").alias("repo"), "number", "language", "base_sha", "merge_sha", "title", "body", "diff"
    )


def mine(args: argparse.Namespace, spark: SparkSession) -> dict:
    """Changes to a dataset of tasks; failed if nothing comes out."""
    made = materialize(plans.build_tasks(_selected(args, spark), "archive"), "mined")
    n = made.count()
    if n:
        dataset.write_parquet(made, args.output)
    return {"status": "success" if n else "failed", "tasks": n, "output": args.output}


def benchmark(args: argparse.Namespace, spark: SparkSession) -> dict:
    """How many rows of a state table reached each stage."""
    cache = spark.read.parquet(args.state)
    statuses = [r[0] for r in cache.where("status is not null").select("status").distinct().orderBy("status").collect()]
    return _rows(state.status_histogram(cache, statuses))[0]


def validate(args: argparse.Namespace, spark: SparkSession) -> dict:
    """Tasks against the facts of their runs, by outcome; failed if none passed."""
    tasks = spark.read.parquet(args.tasks)
    files = F.transform(F.from_json(F.col("meta")["test_files"], "array<struct<path:string,content:string>>"), lambda f: f["path"])
    judged = outcomes.workspace_outcome(tasks.withColumn("test_files", files), spark.read.parquet(args.facts))
    per = {r["outcome"]: r["n"] for r in judged.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    return {"status": "success" if per.get("passed") else "failed", "outcomes": dict(sorted(per.items()))}


def export(args: argparse.Namespace, spark: SparkSession) -> dict:
    """Copies of the kept files of task folders."""
    done = dataset.reexport(spark, args.source, args.output).agg(
        F.count("*").alias("folders"), F.coalesce(F.sum("copied"), F.lit(0)).alias("copied"), F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped")
    ).first()
    return {"status": "success" if done["copied"] else "failed", **done.asDict()}


def harness(args: argparse.Namespace, spark: SparkSession) -> dict:
    """The summary of agent runs from their command facts."""
    facts = spark.read.parquet(args.facts)
    took = facts.where("phase = 'agent'").groupBy("task_id").agg(F.sum("seconds").alias("agent_seconds"))
    runs = reports.run_status(facts).join(took, "task_id", "left")
    return _rows(outcomes.run_summary(runs))[0]


def load(args: argparse.Namespace, spark: SparkSession) -> dict:
    """Statistics of an exported dataset: rows by difficulty, and the ten most frequent languages."""
    rows = materialize(tables.read_dataset(spark, args.dataset, args.split), "loaded")
    n = rows.count()
    levels = reports.counts_by(rows, difficulty=F.col("difficulty_score").cast("string")).orderBy("difficulty")
    return {"status": "success" if n else "empty", "rows": n, "difficulty": _rows(levels), "languages": _rows(reports.top_counts(rows, fold("language"), 10))}


def generate(args: argparse.Namespace, spark: SparkSession) -> dict:
    """Tasks that are handed out, of a category if one is asked for."""
    tasks = spark.read.parquet(args.tasks)
    if args.category:
        want = args.category.lower()
        own = F.lower(F.concat_ws(" ", "language", "repo", "prompt", "id")).contains(want)
        meta = F.coalesce(F.exists(F.map_values("meta"), lambda x: F.lower(x).contains(want)), F.lit(False))
        tasks = tasks.where(own | meta)
    out = rules.first_rows(plans.handed_out(tasks, args.category, args.output), args.count, ["task_id"])
    out = materialize(out, "generated")
    n = out.count()
    if n:
        dataset.write_parquet(out, args.output)
    return {"status": "success" if n or tasks.isEmpty() else "failed", "tasks": n}


def evaluate(args: argparse.Namespace, spark: SparkSession) -> dict:
    """Evaluation results: rates over all and per level, and advice."""
    results = spark.read.parquet(args.results)
    whole = _rows(outcomes.evaluation_summary(results))[0]
    levels = _rows(outcomes.level_rates(results).orderBy("level"))
    return {**whole, "levels": levels, "advice": [r["advice"] for r in outcomes.advice(results).collect()]}


COMMANDS = {f.__name__: f for f in (mine, benchmark, validate, export, harness, load, generate, evaluate)}
_ARGUMENTS = {
    "mine": ("changes", "diffs", "output", "--skip", "--quotas", "--count:1", "--seed:1"),
    "benchmark": ("state",),
    "validate": ("tasks", "facts"),
    "export": ("source", "output"),
    "harness": ("facts",),
    "load": ("dataset", "--split"),
    "generate": ("tasks", "output", "--category", "--count:1"),
    "evaluate": ("results",),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    subs = top.add_subparsers(dest="command", required=True)
    for name, arguments in _ARGUMENTS.items():
        sub = subs.add_parser(name, help=COMMANDS[name].__doc__)
        for a in arguments:
            flag, _, default = a.partition(":")
            sub.add_argument(flag, **({"type": int, "default": int(default)} if default else {}))
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    return COMMANDS[args.command](args, spark or SparkSession.builder.appName("millrace").getOrCreate())


def run() -> None:
    print(json.dumps(main(), ensure_ascii=False, indent=2))
