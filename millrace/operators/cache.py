"""A cache whose entries live for a time: what would have been found in it, what it saves, what it drops."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.reports import ratio


def _walk(ttl: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, since = None, 0
        for b in batches:
            hits, inserted = [], []
            for key, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                hit = key == now and at - since < ttl
                if not hit:
                    now, since = key, at
                hits.append(hit)
                inserted.append(since)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hits), pa.array(inserted, pa.int64())], [*b.schema.names, "hit", "inserted"])

    return run


def ttl_hits(requests: DataFrame, ttl_seconds: float) -> DataFrame:
    """``key, at, id, hit, inserted``: whether an entry of the key is alive when a request comes.

    ``requests(key string, at bigint, id bigint)``, ``at`` in microseconds. An
    entry lives from its insertion, hits do not prolong it; a request without a
    live entry inserts one. Requests of one time count in the order of their
    ids, NULL keys are one key. One pass over rows sorted by key carries a
    single entry, so a key with any number of rows takes no memory.
    """
    narrow = requests.select(F.coalesce("key", F.lit("")).alias("key"), F.col("at").cast("bigint"), F.col("id").cast("bigint"))
    dealt = narrow.where("at is not null").repartition("key").sortWithinPartitions("key", "at", "id")
    return dealt.mapInArrow(_walk(int(ttl_seconds * 1_000_000)), "key string, at bigint, id bigint, hit boolean, inserted bigint")


def cache_stats(walked: DataFrame, tokens: str | None = None) -> DataFrame:
    """One row: hits, misses, entries added, tokens saved by hits, and the share of hits (0 without requests)."""
    saved = F.coalesce(F.sum(F.when(F.col("hit"), F.col(tokens))), F.lit(0)) if tokens else F.lit(0).cast("bigint")
    out = walked.agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), saved.alias("tokens_saved"))
    return out.select("hits", "misses", F.col("misses").alias("added"), "tokens_saved", ratio(F.col("hits"), F.col("hits") + F.col("misses")).alias("hit_rate"))


def evicted(entries: DataFrame, room: int, *, now: int | None = None, ttl_seconds: float = 0) -> DataFrame:
    """``key`` of the entries that must go: the expired ones, then of the rest the longest unused beyond ``room``.

    ``entries(key, created bigint, used bigint)`` in microseconds; ties go by key.
    """
    old = F.lit(False) if now is None else F.lit(now) - F.col("created") >= F.lit(int(ttl_seconds * 1_000_000))
    alive = entries.where(~old)
    kept = alive.orderBy(F.desc("used"), "key").limit(room).select("key")
    return entries.where(old).select("key").unionByName(alive.select("key").join(kept, "key", "left_anti"))
