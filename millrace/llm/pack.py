"""Problem 8: filling containers of fixed capacity, with certified bin counts.

Documents fall into partitions of bounded size. Each is packed by best-fit
decreasing, and dual feasible functions give a lower bound on the containers
any packing of it needs. Where both agree the partition is certified optimal
and settled. Partitions with a gap keep their full containers, put the
documents of the others into a common pool, and the pool is dealt anew and
packed again, until it is one partition or hardly shrinks any more; that round
settles what is left.

Only identifiers and token counts are packed, never texts.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokens import token_count
from millrace.runtime import materialize, spread

ITEMS = 20_000  # documents of one partition and profile
STABLE = 0.9  # a pool that keeps more than this share of its items has stopped to shrink
FULL = 0.995  # a container this full is kept when its partition has a gap


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Containers that any packing of ``sizes`` needs.

    The best of the dual feasible functions u(k) (steps of 1/k) and of the
    threshold functions that count items over half the capacity whole.
    """
    if not len(sizes):
        return 0
    best = -(-int(sizes.sum()) // capacity)
    values, counts = np.unique(sizes, return_counts=True)
    for k in range(1, 9):
        scaled = values * (k + 1)
        exact = scaled % capacity == 0
        twice = np.where(exact, values * k, (scaled // capacity) * capacity)  # u(k) * k * capacity
        best = max(best, -(-int((twice * counts).sum()) // (k * capacity)))
    thresholds = values[values * 2 <= capacity]
    if len(thresholds):
        counted, massed = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(values * counts)))
        over = np.searchsorted(values, capacity - thresholds, "right")  # from here on items count whole
        small = np.searchsorted(values, thresholds)  # up to here they do not count
        mass = capacity * (counted[-1] - counted[over]) + massed[over] - massed[small]
        best = max(best, -(-int(mass.max()) // capacity))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item; every size lies in 1..capacity."""
    where = np.empty(len(sizes), dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]  # containers by room left
    rooms = 0  # bit r: some container has room r
    made = 0
    for i in np.lexsort((np.arange(len(sizes)), -sizes)).tolist():
        s = int(sizes[i])
        fits = rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            box = open_[room].pop()
            if not open_[room]:
                rooms &= ~(1 << room)
        else:
            room, box, made = capacity, made, made + 1
        where[i] = box
        left = room - s
        if left:
            open_[left].append(box)
            rooms |= 1 << left
    return where


def _pack_group(last: bool):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable").reset_index(drop=True)
        capacity = int(pdf["capacity"].iloc[0])
        sizes = pdf["tokens"].to_numpy(dtype=np.int64)
        box = best_fit_decreasing(sizes, capacity)
        used = np.bincount(box, weights=sizes)
        bound = lower_bound(sizes, capacity)
        certified = len(used) == bound
        keep = np.ones(len(used), dtype=bool) if certified or last else used >= FULL * capacity
        pdf["box"] = np.where(keep[box], box, -1)
        pdf["certified"] = certified
        return pdf

    return pack


def _items(documents: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every piece to pack: whole documents, or chunks of those over capacity."""
    sized = spread(documents.where("doc_id is not null").select("doc_id", "text")).select("doc_id", token_count("text").alias("tokens")).where("tokens > 0")
    caps = profiles.where("capacity_tokens >= 1").select("profile", F.col("capacity_tokens").alias("capacity")).distinct()
    rows = [(r["profile"], int(r["capacity"])) for r in caps.collect()]  # a handful of profiles
    shapes = F.array(*[F.struct(F.lit(p).alias("profile"), F.lit(c).cast("bigint").alias("capacity")) for p, c in rows])
    if not rows:
        shapes = F.from_json(F.lit("[]"), "array<struct<profile:string,capacity:bigint>>")
    pieces = F.expr("sequence(1L, ceil(tokens / capacity))")
    return (
        sized.select("doc_id", F.col("tokens").alias("whole"), F.explode(shapes).alias("s"))
        .select("doc_id", F.col("whole").alias("tokens"), "s.profile", "s.capacity")
        .withColumn("n_pieces", F.ceil(F.col("tokens") / F.col("capacity")).cast("bigint"))
        .withColumn("piece", F.explode(pieces))
        .withColumn("tokens", F.least("capacity", F.col("tokens") - (F.col("piece") - 1) * F.col("capacity")))
        .select("profile", "capacity", "doc_id", "piece", "n_pieces", "tokens")
    )


OUT = "profile string, capacity bigint, doc_id bigint, piece bigint, n_pieces bigint, tokens bigint, part bigint, box bigint, certified boolean"


def pack(documents: DataFrame, profiles: DataFrame) -> DataFrame:
    """``profile, doc_id, piece, n_pieces, tokens, container, certified`` for every piece.

    A document is split only if it has more tokens than the capacity; its
    pieces are full but for the last. Texts that are NULL or hold no token
    need no room and get no row, nor do documents without an id. Repeated profiles count once. ``certified``
    tells that the piece's partition was packed with provably few containers.
    """
    pool = materialize(_items(documents, profiles), "pack")
    settled: list[DataFrame] = []
    before = float("inf")
    for r in itertools.count():
        n = pool.count()
        if not n:
            break
        parts = max(1, -(-n // ITEMS))
        last = parts == 1 or n > STABLE * before
        dealt = pool.withColumn("part", F.pmod(F.xxhash64(F.lit(r), "doc_id", "piece"), F.lit(parts)))
        packed = materialize(dealt.groupBy("profile", "part").applyInPandas(_pack_group(last), OUT), "pack")
        name = F.concat_ws("-", "profile", F.lit(r).cast("string"), F.col("part").cast("string"), F.col("box").cast("string"))
        settled.append(packed.where("box >= 0").withColumn("container", name))
        if last:
            break
        before, pool = n, packed.where("box < 0").select(pool.columns)
    cols = ["profile", "doc_id", "piece", "n_pieces", "tokens", "container", "certified"]
    if not settled:
        return pool.withColumns({"container": F.lit(""), "certified": F.lit(True)}).select(cols)
    out = settled[0].select(cols)
    for more in settled[1:]:
        out = out.unionByName(more.select(cols))
    return out


def fill_report(documents: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per profile: containers, tokens, share of room used, and the volume bound on containers."""
    packed = pack(documents, profiles)
    caps = profiles.select("profile", F.col("capacity_tokens").cast("bigint").alias("capacity")).distinct()
    return (
        packed.groupBy("profile", "container")
        .agg(F.sum("tokens").alias("tokens"))
        .groupBy("profile")
        .agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"))
        .join(F.broadcast(caps), "profile")
        .select(
            "profile",
            "capacity",
            "containers",
            "tokens",
            (F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("fill"),
            F.ceil(F.col("tokens") / F.col("capacity")).alias("least_containers"),
        )
    )
