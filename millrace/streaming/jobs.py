"""Structured Streaming: hourly counts, de-duplication, state and shards of arriving event files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.operators.dedup import event_number, keep_one
from millrace.runtime import fold, utrim


def event_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 16) -> DataFrame:
    """Event files as they arrive. ``created_at`` must be a timestamp with a zone to carry a watermark."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def hourly_counts(events: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """``hour, event_type, n`` per hour of the event; later events than ``lateness`` are not counted."""
    return (
        events.withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", "1 hour"), "event_type")
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("hour"), "event_type", "n")
    )


def distinct_messages(events: DataFrame, lateness: str = "7 days") -> DataFrame:
    """The first delivery of each message; state older than ``lateness`` is forgotten.

    A copy that comes later than that passes; :func:`unseen` drops it where a
    table of what was delivered is kept. Ids without a number count as written,
    rows without an id stay unless the whole row repeats.
    """
    keyed = events.select(
        "*",
        F.coalesce(event_number("id").cast("string"), F.concat(F.lit("id "), utrim("id")), F.concat(F.lit("row "), F.xxhash64(F.to_json(F.struct("*"))))).alias("_no"),
        fold("repository").alias("_repo"),
    )
    kept = keyed.withWatermark("ingested_at", lateness).dropDuplicatesWithinWatermark(["_no", "_repo", "pull_number"])
    return kept.drop("_no", "_repo")


def unseen(batch: DataFrame, delivered: DataFrame, order_by: tuple[str, ...] = ("ingested_at",)) -> DataFrame:
    """The messages of a batch that a table of delivered ones (same columns) does not hold, however old; one copy of each."""
    name = F.coalesce(event_number("id").cast("string"), F.concat(F.lit("id "), utrim("id")))
    key = lambda d: d.select(name.alias("_no"), fold("repository").alias("_repo"), F.col("pull_number").alias("_pr")).distinct()
    one, old = keep_one(batch, order_by).withColumn("_no", name), key(delivered)
    same = (one["_no"] == old["_no"]) & fold("repository").eqNullSafe(old["_repo"]) & F.col("pull_number").eqNullSafe(old["_pr"])
    return one.join(old, same, "left_anti").drop("_no")


def spending_by_day(records: DataFrame, at: str, value: str, lateness: str = "1 day") -> DataFrame:
    """``day, spent`` of a stream of records, one running row per day; a day's counter starts anew at midnight UTC."""
    return (
        records.withWatermark(at, lateness)
        .groupBy(F.window(at, "1 day"))
        .agg(F.sum(value).alias("spent"))
        .select(F.col("window.start").cast("date").alias("day"), "spent")
    )


def ttl_stream(requests: DataFrame, ttl_seconds: float) -> DataFrame:
    """``key, id, at, hit`` of a stream of requests ``(key string, id bigint, at timestamp)``: whether an entry of the key is alive.

    The state of a key is one number, the time its entry was inserted. An expired
    one is replaced by the next request and stays until then.
    """

    def walk(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since = state.get[0] if state.exists else None
        for pdf in batches:
            pdf = pdf.sort_values(["at", "id"], kind="stable")
            micros = (pdf["at"].astype("int64") // (1000 if pdf["at"].dtype.str.endswith("[ns]") else 1)).tolist()
            hits = []
            for at in micros:
                hits.append(since is not None and at - since < ttl_seconds * 1_000_000)
                since = since if hits[-1] else at
            yield pd.DataFrame({"key": key[0], "id": pdf["id"].to_numpy(), "at": pdf["at"].to_numpy(), "hit": hits})
        if since is not None:
            state.update((since,))

    return requests.groupBy("key").applyInPandasWithState(
        walk, "key string, id bigint, at timestamp, hit boolean", "since bigint", "append", GroupStateTimeout.NoTimeout
    )


def progress_rows(reports: list[dict]) -> list[tuple[int, int, float]]:
    """``batch, rows, rows per second`` of the progress reports of a query, for a monitor."""
    return [(int(r["batchId"]), int(r["numInputRows"]), float(r.get("processedRowsPerSecond") or 0.0)) for r in reports]


def run_once(df: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Process all files there are and stop; a rerun goes on where the last one ended."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(target).awaitTermination()


def shards_once(df: DataFrame, target: str, checkpoint: str, size: int | None = None) -> None:
    """Append every micro-batch as its own shard, in files of at most ``size`` rows; a batch that is repeated replaces its shard."""

    def flush(batch: DataFrame, batch_id: int) -> None:
        out = batch.write.mode("overwrite").option("compression", "zstd")
        (out.option("maxRecordsPerFile", size) if size else out).parquet(f"{target}/shard={batch_id}")

    query = df.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
