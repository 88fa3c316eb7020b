"""Problem 9: mixing sources to target weights by weighted fair queueing.

Every copy of a document queues at its source in a seeded random order. Its
virtual finish time is the tokens its source has served up to and including it,
divided by the source's weight. Serving all queues in the order of finish times
gives every prefix of the mixture the target shares; the mixture ends where the
next document would exceed the token budget. Sources that run out leave their
room to the others, in proportion to their weights.

How far the queues are served at all is worked out first, on one row per
source: the time at which the budget and the largest document of each source
would be served if tokens were a fluid. Only as many rounds of a source as that
time needs are queued. Running sums go in steps (slices, blocks of slices), so
no task ever holds a source or the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import token_count
from millrace.runtime import materialize, spread, sums_before

SLICE_ROWS = 20_000


def _sized(documents: DataFrame) -> DataFrame:
    return spread(documents.select("doc_id", "source", "text")).select("doc_id", "source", token_count("text").alias("tokens"))


def _targets(targets: DataFrame) -> DataFrame:
    """One row per source; the table of targets is as small as the list of sources."""
    return (
        targets.where("source is not null")
        .groupBy("source")
        .agg(
            F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight"),
            F.coalesce(F.max("max_repeats"), F.lit(1)).cast("bigint").alias("max_repeats"),
        )
    )


def _supply(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target its tokens and documents beside the tokens of all documents (the budget)."""
    per = sized.groupBy("source").agg(
        F.sum("tokens").alias("tokens"), F.count_if(F.col("tokens") > 0).alias("docs"), F.max("tokens").alias("longest")
    )
    budget = sized.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    return (
        _targets(targets)
        .join(per, "source", "left")
        .select(
            "source",
            "weight",
            "max_repeats",
            F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"),
            F.coalesce("docs", F.lit(0)).alias("docs"),
            F.coalesce("longest", F.lit(0)).alias("longest"),
            F.lit(budget).cast("bigint").alias("budget"),
        )
    )


def fluid_time(sources: list[tuple[float, int]], amount: float) -> float:
    """When so many tokens are served by ``(weight, tokens to serve)`` sources; when all are empty, if that is sooner."""
    time, served = 0.0, 0.0
    order = sorted((t / w, w) for w, t in sources if w > 0 and t > 0)
    rate = sum(w for _, w in order)
    for empty, w in order:
        if served + rate * (empty - time) >= amount:
            return time + (amount - served) / rate
        served, time, rate = served + rate * (empty - time), empty, max(rate - w, 0.0)
    return time


def _queues(supply: DataFrame) -> tuple[DataFrame, float, int]:
    """Per source how many rounds are queued, the time that ends the queues, and the budget; a row per target reaches the driver."""
    rows = [r.asDict() for r in supply.where("weight > 0 and tokens > 0").collect()]
    budget = rows[0]["budget"] if rows else 0
    repeats = lambda r: max(r["max_repeats"], 1)
    end = fluid_time([(r["weight"], r["tokens"] * repeats(r)) for r in rows], budget + sum(r["longest"] for r in rows))
    queued = [
        (r["source"], r["weight"], r["docs"], min(repeats(r), int(r["weight"] * end // r["tokens"]) + 1)) for r in rows
    ]
    made = supply.sparkSession.createDataFrame(queued, "source string, weight double, docs bigint, rounds bigint")
    return made, end, budget


def _finish(sized: DataFrame, queues: DataFrame, seed: int) -> DataFrame:
    """Every queued copy with its virtual finish time. ``queues`` has at most one row per target, so it is broadcast."""
    scale = F.greatest(F.lit(1), F.ceil(F.col("docs") / F.lit(SLICE_ROWS)))
    copies = (
        sized.where("tokens > 0")
        .join(F.broadcast(queues), "source")
        .withColumn("copy", F.explode(F.expr("sequence(1L, rounds)")))
        .withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "copy"))
        .withColumn("slice", F.floor(F.shiftrightunsigned("draw", 33) * scale / F.lit(float(1 << 31))).cast("bigint"))
        .withColumn("slice", (F.col("copy") - 1) * scale.cast("bigint") + F.col("slice"))
    )
    at = ["source", "slice"]
    held = copies.groupBy(*at).agg(F.sum("tokens").alias("held"))
    before = sums_before(held, ["source"], "slice", "held", "before").select(*at, "before")
    inside = Window.partitionBy(*at).orderBy(F.shiftleft("draw", 31), "doc_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    served = F.col("before") + F.col("within")
    return (
        copies.withColumn("within", F.sum("tokens").over(inside))
        .join(before, at)
        .select("source", "doc_id", "copy", "tokens", (served / F.col("weight")).alias("finish"))
    )


def mixture(documents: DataFrame, targets: DataFrame, seed: int = 11) -> DataFrame:
    """The mixture: ``source, doc_id, copy, tokens, finish, position``.

    The budget is the number of tokens of all documents, those of NULL and
    unlisted sources included, and is never exceeded. A document comes at most
    ``max_repeats`` times (every copy of a source once before any comes
    again). Texts without tokens and documents of other sources are not mixed.
    ``position`` numbers the mixture from 1 in the order of finish times, ties
    by source, document and copy.
    """
    return _mixture(materialize(_sized(documents), "mix"), targets, seed)


def _mixture(sized: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    queues, end, budget = _queues(_supply(sized, targets))
    queued = materialize(_finish(sized, queues, seed).where(F.col("finish") <= F.lit(end)), "mix")
    ranges = max(1, -(-queued.count() // SLICE_ROWS))
    at = F.least(F.floor(F.col("finish") / F.lit(end or 1.0) * F.lit(ranges)), F.lit(ranges - 1)).cast("bigint")
    ranged = queued.withColumn("range", at)
    held = ranged.groupBy("range").agg(F.count("*").alias("n"), F.sum("tokens").alias("held"))
    starts = sums_before(sums_before(held, [], "range", "n", "start"), [], "range", "held", "spent")
    inside = Window.partitionBy("range").orderBy("finish", "source", "doc_id", "copy")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.withColumns({"rn": F.row_number().over(inside), "within": F.sum("tokens").over(upto)})
        .join(starts.select("range", "start", "spent"), "range")
        .where(F.col("spent") + F.col("within") <= F.lit(budget))
        .select("source", "doc_id", "copy", "tokens", "finish", (F.col("start") + F.col("rn")).alias("position"))
    )


def supply_report(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source what it holds, what its share asks for, and whether it falls short.

    An absent source holds 0 tokens; with an empty corpus every source meets
    its share of nothing.
    """
    return _report(_sized(documents), targets)


def _report(sized: DataFrame, targets: DataFrame) -> DataFrame:
    return _supply(sized, targets).select(
        "source",
        "weight",
        "max_repeats",
        "tokens",
        "budget",
        (F.col("tokens") * F.col("max_repeats") < F.col("weight") * F.col("budget")).alias("short"),
    )


def mix_report(documents: DataFrame, targets: DataFrame, seed: int = 11) -> DataFrame:
    """Per target source its wanted and actual share of the mixture's tokens."""
    sized = materialize(_sized(documents), "mix")
    made = _mixture(sized, targets, seed).groupBy("source").agg(
        F.sum("tokens").alias("mixed"), F.count("*").alias("served"), F.max("copy").alias("rounds")
    )
    whole = Window.partitionBy(F.lit(1))
    mixed = F.coalesce("mixed", F.lit(0))
    return (
        _report(sized, targets)
        .join(made, "source", "left")
        .select(
            "source",
            "weight",
            "max_repeats",
            "tokens",
            "short",
            mixed.cast("bigint").alias("mixed_tokens"),
            F.coalesce("served", F.lit(0)).alias("served"),
            F.coalesce("rounds", F.lit(0)).alias("rounds"),
            F.coalesce(mixed / F.nullif(F.sum(mixed).over(whole), F.lit(0)), F.lit(0.0)).alias("actual_share"),
            (mixed / F.nullif(F.col("budget"), F.lit(0))).alias("share_of_budget"),
        )
    )
