"""Problem 6: near-duplicate texts, by PartEnum signatures.

Texts become sets of hashed word shingles. Two sets with Jaccard similarity g
or more differ in at most (1-g)/(1+g) * (|a|+|b|) elements. PartEnum cuts the
feature domain into first-level partitions, so many that one of them holds at
most ``OFF`` of the differences, and each of these into ``CELLS`` second-level
ones. Every subset of ``CELLS - OFF`` cells of a first-level partition is
enumerated and, with its content, a signature: in the partition with few
differences one subset is untouched, and both sets hold its signature. Sizes
are banded, and every pair of bands whose sets can be similar is an instance
with a domain cut of its own.

What keeps the signatures few, and exact:

* A shingle that only one text holds ("lone") is always a difference. A set
  whose share of such shingles exceeds 1-g has no partner and drops out, and
  the rest are signed without them.
* A signature must hold a shingle that at most ``HOT`` sets hold, so that
  boilerplate never brings sets together by itself.
* Cells without such a shingle say nothing. Each set adds up how many
  differences it takes to spoil all of its signatures; where that is not more
  than similarity allows (a thin set), its rarest shingles are signatures
  beside them (a prefix filter). Of a similar pair either one set cannot be
  spoiled, or both are thin and share one of those, so no pair is lost.
* Equal texts form classes beforehand; one member stands for them.

Shingles that a hundredth of the sets hold are counted where they are made and
never gathered by shingle, so a licence line held by all texts fills no task.

Candidates are verified on the shingle sets themselves. Nothing is sampled or
capped, and no set of pairs is formed but by a shared signature.
"""

from __future__ import annotations

import hashlib
import math
from itertools import combinations
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import materialize, spread

WORDS = 3
SIMILARITY = 0.6
BUCKET_SETS = 10_000  # sets whose shingles one bucket of the domain holds on average
CELLS, OFF = 3, 1  # second-level partitions, and how many of them may differ
SLACK = 1.6  # first-level partitions by the fewest there must be
HOT = 256  # a signature needs a shingle that no more sets hold
HEAVY = 0.01  # share of the sets of a piece from which on a shingle is counted there
STAR = 64  # more texts equal byte by byte are linked to their smallest member only

_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)  # odd: powers stay invertible modulo 2**64
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20250101).integers(1, 1 << 62, 256, dtype=np.uint64)
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(97, 123), 95]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``words`` consecutive words.

    Words are maximal runs of ``[a-z0-9_]`` in the lower-cased text. NULL and
    texts with fewer words have the empty set.
    """
    data = np.frombuffer("\n".join((t or "").lower().replace("\n", " ") for t in texts).encode("utf-8", "replace") + b"\n", np.uint8)
    inside = _IN_WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return [np.empty(0, np.uint64) for _ in texts]
    power = np.cumprod(np.concatenate(([_U(1)], np.full(len(data), _MUL))), dtype=np.uint64)
    prefix = np.concatenate(([_U(0)], np.cumsum(_BYTES[data] * power[:-1], dtype=np.uint64)))
    inverse = np.cumprod(np.concatenate(([_U(1)], np.full(len(data), _INV))), dtype=np.uint64)
    hashes = mix((prefix[stop] - prefix[start]) * inverse[start] + (stop - start).astype(np.uint64))
    row = np.searchsorted(np.flatnonzero(data == 10), start)
    if len(hashes) < words:
        return [np.empty(0, np.uint64) for _ in texts]
    n = len(hashes) - words + 1
    gram = np.zeros(n, np.uint64)
    for k in range(words):
        gram = mix(gram * _U(31) + hashes[k : k + n] + _U(k + 1))
    gram = gram[row[:n] == row[words - 1 :]]
    at = row[:n][row[:n] == row[words - 1 :]]
    order = np.lexsort((gram, at))
    gram, at = gram[order], at[order]
    first = np.ones(len(gram), bool)
    first[1:] = (gram[1:] != gram[:-1]) | (at[1:] != at[:-1])
    gram, at = gram[first], at[first]
    cut = np.searchsorted(at, np.arange(len(texts) + 1))
    return [gram[cut[i] : cut[i + 1]] for i in range(len(texts))]


# ------------------------------------------------------- classes of equal sets
SETS = "row_id bigint, side int, size int, content bigint, content2 bigint, text binary"


def _batches(b: pa.RecordBatch, words: int, step: int = 2000) -> Iterator[tuple[int, list[int], list[np.ndarray], list[str]]]:
    """Side, row keys, non-empty shingle sets and their texts of a batch of rows, piece by piece."""
    ids = b.column(0).to_pylist()
    for side in range(1, b.num_columns):
        for lo in range(0, len(ids), step):
            texts = b.column(side).slice(lo, step).to_pylist()
            sets = shingle_sets(texts, words)
            keep = [i for i, s in enumerate(sets) if len(s)]
            if keep:
                yield side, [ids[lo + i] for i in keep], [sets[i] for i in keep], [texts[i] for i in keep]


LEAST_HEAVY = 10  # and the least number of sets of a piece for that


def _salted(keys: np.ndarray, side: int) -> np.ndarray:
    """Shingles of different fields never meet."""
    return mix(keys ^ mix(np.array([side], np.uint64)))


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for side, ids, sets, texts in _batches(b, words):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([side] * len(ids), pa.int32()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([int(np.bitwise_xor.reduce(mix(s)).astype(np.int64)) for s in sets], pa.int64()),
                        pa.array([int(np.add.reduce(mix(s ^ _MUL)).astype(np.int64)) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts], pa.binary()),
                    ],
                    [x.split()[0] for x in SETS.split(", ")],
                )
                # frequent shingles of the piece as rows of side -1: the shingle (salted by side) and its count
                keys, n = np.unique(_salted(np.concatenate(sets), side), return_counts=True)
                often = n >= max(HEAVY * len(sets), LEAST_HEAVY)
                keys, n = keys[often].view(np.int64), n[often]
                none = pa.nulls(len(keys), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array([-1] * len(keys), pa.int32()), pa.array(n.astype(np.int32)), none, none, pa.nulls(len(keys), pa.binary())],
                    [x.split()[0] for x in SETS.split(", ")],
                )

    return run


# --------------------------------------- shingles that more than one set holds
PACKED = "bucket int, ids binary, sides binary, keys binary, counts binary"


def _pack(bucket: np.ndarray, ids: np.ndarray, sides: np.ndarray, keys: np.ndarray | None, counts: np.ndarray | None) -> pa.RecordBatch:
    """One message per bucket; a shuffle of packed arrays has no cost per entry but its bytes."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else np.zeros(1, int)
    spans = list(zip(edge[:-1], edge[1:]))

    def column(x: np.ndarray | None, kind: type) -> pa.Array:
        if x is None:
            return pa.array([b""] * len(spans), pa.binary())
        x = x[order].astype(kind, copy=False)
        return pa.array([x[a:b].tobytes() for a, b in spans], pa.binary())

    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[edge[:-1]].astype(np.int32)),
            column(ids, np.int64),
            column(sides, np.int8),
            column(keys, np.uint64),
            column(counts, np.int32),
        ],
        [x.split()[0] for x in PACKED.split(", ")],
    )


def _deal(words: int, buckets: int, heavy: np.ndarray, heavy_n: np.ndarray):
    """Every shingle with its set, packed by bucket of the shingle domain; heavy ones, with their count, by bucket of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for side, ids, sets, _ in _batches(b, words):
                sizes = [len(s) for s in sets]
                keys = _salted(np.concatenate(sets), side)
                own = np.repeat(np.array(ids, np.int64), sizes)
                sides = np.full(len(keys), side)
                if len(heavy):
                    at = np.minimum(np.searchsorted(heavy, keys), len(heavy) - 1)
                    known = heavy[at] == keys
                    bucket = (mix(own[known].astype(np.uint64)) % _U(buckets)).astype(np.int64)
                    yield _pack(bucket, own[known], sides[known], keys[known], heavy_n[at[known]])
                    keys, own, sides = keys[~known], own[~known], sides[~known]
                yield _pack((keys % _U(buckets)).astype(np.int64), own, sides, keys, None)

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, ...]]]:
    """The messages of one bucket after the other; a task's rows are sorted by bucket."""
    now, parts = None, []
    for b in batches:
        for bucket, *rest in zip(*(b.column(i).to_pylist() for i in range(5))):
            if bucket != now and parts:
                yield parts
                parts = []
            now = bucket
            parts.append(tuple(rest))
    if parts:
        yield parts


def _unpack(parts: list[tuple[bytes, ...]]) -> list[np.ndarray]:
    kinds = (np.int64, np.int8, np.uint64, np.int32)
    return [np.concatenate([np.frombuffer(p[k], kind) for p in parts]) for k, kind in enumerate(kinds)]


def _shared(buckets: int):
    """Of each bucket the shingles with several sets, packed by bucket of the row keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _by_bucket(batches):
            counted = [p for p in parts if p[3]]
            if counted:  # heavy shingles go on as they are
                ids, sides, keys, df = _unpack(counted)
                yield _pack((mix(ids.astype(np.uint64)) % _U(buckets)).astype(np.int64), ids, sides, keys, df)
            parts = [p for p in parts if not p[3]]
            if not parts:
                continue
            ids, sides, keys, _ = _unpack(parts)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            runs = np.diff(np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True]))))
            df = np.repeat(runs, runs)
            keep = df > 1
            order = order[keep]
            at = (mix(ids[order].astype(np.uint64)) % _U(buckets)).astype(np.int64)
            yield _pack(at, ids[order], sides[order], keys[keep], df[keep])

    return run


def _heads(buckets: int):
    """Row keys and set sizes of class heads, packed like the shingles of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sides, sizes = (np.asarray(b.column(i).to_numpy(zero_copy_only=False), np.int64) for i in range(3))
            yield _pack((mix(ids.astype(np.uint64)) % _U(buckets)).astype(np.int64), ids, sides, None, sizes)

    return run


HELD = "row_id bigint, side int, size int, keys binary, dfs binary"


def _gather(similarity: float):
    """Per class head that may have a partner: its size and the shingles other sets hold too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _by_bucket(batches):
            heads, entries = [p for p in parts if not p[2]], [p for p in parts if p[2]]
            if not heads or not entries:
                continue
            h_ids, h_sides, _, h_sizes = _unpack(heads)
            ids, sides, keys, df = _unpack(entries)
            order = np.lexsort((keys, sides, ids))
            ids, sides, keys, df = ids[order], sides[order], keys[order], df[order]
            edge = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (sides[1:] != sides[:-1]), [True])))
            spans = {(ids[a], sides[a]): (a, b) for a, b in zip(edge[:-1], edge[1:])}
            out = []
            for i, s, n in zip(h_ids.tolist(), h_sides.tolist(), h_sizes.tolist()):
                a, b = spans.get((i, s), (0, 0))
                if b - a >= similarity * n - 1e-9 and b > a:
                    out.append((i, s, n, keys[a:b].tobytes(), df[a:b].tobytes()))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in out], t) for k, t in enumerate(types)], [x.split()[0] for x in HELD.split(", ")]
            )

    return run


# ------------------------------------------------------------------ signatures
def band(size: int, similarity: float) -> int:
    """Band t holds the sizes from (1/g)**t up to below (1/g)**(t+1), so partners are in the same or a neighbouring band."""
    return int(math.floor(math.log(size) / -math.log(similarity) + 1e-9))


def largest(t: int, similarity: float) -> int:
    return max(1, math.ceil(similarity ** -(t + 1) - 1e-6) - 1)


def instances(size: int, similarity: float) -> list[tuple[int, int, int, int]]:
    """``smaller band, larger band, differences of any pair, differences of this set's pairs`` of every instance a set is in."""
    part = (1 - similarity) / (1 + similarity)
    own = band(size, similarity)
    least, furthest = math.ceil(similarity * size - 1e-9), math.floor(size / similarity + 1e-9)
    out = []
    for other in range(max(0, own - 1), own + 2):
        low, high = min(own, other), max(own, other)
        most = min(furthest, largest(other, similarity))
        if most < max(least, 1):
            continue
        any_pair = largest(low, similarity) + min(largest(high, similarity), math.floor(largest(low, similarity) / similarity + 1e-9))
        out.append((low, high, math.floor(part * any_pair + 1e-9), math.floor(part * (size + most) + 1e-9)))
    return out


_SUBSETS = np.array(list(combinations(range(CELLS), CELLS - OFF)))


def signatures(side: int, size: int, keys: np.ndarray, dfs: np.ndarray, similarity: float) -> tuple[np.ndarray, bool]:
    """The signatures of a set, and whether it is thin.

    ``keys`` are the shingles that other sets hold too and ``dfs`` how many
    hold each; ``size`` counts the lone ones as well.
    """
    alone = size - len(keys)
    out: list[np.ndarray] = []
    thin = False
    hashed = mix(keys)
    cool = dfs <= HOT
    for low, high, any_pair, own in instances(size, similarity):
        if own < alone:
            continue
        firsts = math.ceil(SLACK * (any_pair + 1) / (OFF + 1))
        salt = mix(np.array([(low * 4096 + high) * 4 + side], np.uint64))
        cell = (mix(keys ^ salt) % _U(firsts * CELLS)).astype(np.int64)
        content = np.zeros(firsts * CELLS, np.uint64)
        np.add.at(content, cell, hashed)
        told = (np.bincount(cell[cool], minlength=firsts * CELLS) > 0).reshape(firsts, CELLS)
        content = content.reshape(firsts, CELLS)
        thin |= int(np.minimum(told.sum(axis=1), OFF + 1).sum()) <= own - alone
        sig = np.zeros((firsts, len(_SUBSETS)), np.uint64)
        for k in range(CELLS - OFF):
            sig = mix(sig * _U(31) + content[:, _SUBSETS[:, k]])
        place = np.arange(firsts * len(_SUBSETS), dtype=np.uint64).reshape(sig.shape)
        out.append(mix(sig ^ mix(place + salt))[told[:, _SUBSETS].any(axis=2)])
    if thin:
        # partners hold at least g*size shingles of this set, so the rarest others plus one hold one of them
        most = max(0, size - math.ceil(similarity * size - 1e-9) + 1 - alone)
        out.append(mix(keys[np.lexsort((keys, dfs))[:most]] ^ mix(np.array([side], np.uint64))))
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), thin


def _sign(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sides, sizes, keys, dfs = (b.column(i).to_pylist() for i in range(5))
            sig = [
                signatures(s, n, np.frombuffer(k, np.uint64), np.frombuffer(d, np.int32), similarity)[0]
                for s, n, k, d in zip(sides, sizes, keys, dfs)
            ]
            each = [len(x) for x in sig]
            flat = np.concatenate(sig) if sig else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(flat.view(np.int64)),
                    pa.array(np.repeat(np.array(ids, np.int64), each)),
                    pa.array(np.repeat(np.array(sides, np.int32), each)),
                    pa.array(np.repeat(np.array(sizes, np.int32), each)),
                ],
                ["sig", "row_id", "side", "size"],
            )

    return run


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            col = {n: b.column(i).to_pylist() for i, n in enumerate(names)}
            keep, value = [], []
            for i, (x, y, m, n) in enumerate(zip(col["keys_a"], col["keys_b"], col["size_a"], col["size_b"])):
                a, c = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(a, c, assume_unique=True))
                if both >= similarity * (m + n - both) - 1e-9:
                    keep.append(i)
                    value.append(both / (m + n - both))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([col["row_a"][i] for i in keep], pa.int64()),
                    pa.array([col["row_b"][i] for i in keep], pa.int64()),
                    pa.array([col["side"][i] for i in keep], pa.int32()),
                    pa.array(value, pa.float64()),
                ],
                ["row_a", "row_b", "side", "similarity"],
            )

    return run


# -------------------------------------------------------------------- operator
class Links:
    """``members(side, row_id, class_id, copies, text_id, same)`` and ``pairs(row_a, row_b, side, similarity)`` of class ids.

    ``text_id`` is the smallest row key with the very same text, ``same`` how many rows have it.
    """


    def __init__(self, members: DataFrame, pairs: DataFrame) -> None:
        self.members, self.pairs = members, pairs


def near_duplicates(
    rows: DataFrame,
    fields: tuple[str, ...] = ("patch", "test_patch"),
    row_key: str = "row_id",
    words: int = WORDS,
    similarity: float = SIMILARITY,
) -> Links:
    """Classes of equal shingle sets, and all pairs of classes at least ``similarity`` alike.

    Fields are compared each with itself. NULL and empty texts, and texts of
    fewer than ``words`` words, match nothing and belong to no class, nor do
    rows without a key. A class id is the smallest row key of its members.
    """
    keyed_rows = rows.where(F.col(row_key).isNotNull())
    narrow = spread(keyed_rows.select(F.col(row_key).cast("bigint"), *[F.col(f).cast("string") for f in fields]))
    made = materialize(narrow.mapInArrow(_sets(words), SETS), "neardup")
    keyed = made.where("side > 0")
    same = ["side", "content", "content2", "size"]
    classes = keyed.groupBy(same).agg(F.min("row_id").alias("class_id"), F.count("*").alias("copies"))
    alike = keyed.groupBy(*same, "text").agg(F.min("row_id").alias("text_id"), F.count("*").alias("same"))
    members = keyed.join(classes, same).join(alike, [*same, "text"])
    members = members.select("side", "row_id", "class_id", "copies", "text_id", "same", "size")
    members = materialize(members, "neardup")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held_sets = members.count()
    buckets = max(parts, held_sets // BUCKET_SETS)
    # shingles of at least half a HEAVY share, so no more than sets hold on average, times 2 / HEAVY
    often = made.where("side = -1").groupBy("row_id").agg(F.sum("size").alias("n")).where(F.col("n") >= F.lit(HEAVY / 2 * held_sets))
    known = sorted((r[0] & (1 << 64) - 1, r[1]) for r in often.collect())
    heavy, heavy_n = np.array([k for k, _ in known], np.uint64), np.array([n for _, n in known], np.int32)

    def exchange(df: DataFrame) -> DataFrame:
        # by id, not by hash: a hash would give some tasks several buckets and others none
        return df.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket")

    dealt = narrow.mapInArrow(_deal(words, buckets, heavy, heavy_n), PACKED)
    shared = exchange(dealt).mapInArrow(_shared(buckets), PACKED)
    heads = members.where("row_id = class_id").select("row_id", "side", "size").mapInArrow(_heads(buckets), PACKED)
    held = materialize(exchange(shared.unionByName(heads)).mapInArrow(_gather(similarity), HELD), "neardup")
    signed = held.mapInArrow(_sign(similarity), "sig bigint, row_id bigint, side int, size int")
    signed = materialize(signed, "neardup")
    often = signed.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1").select("sig")
    left = signed.join(often, "sig", "left_semi")
    a = left.select("sig", "side", F.col("row_id").alias("row_a"), F.col("size").alias("size_a"))
    b = left.select("sig", "side", F.col("row_id").alias("row_b"), F.col("size").alias("size_b"))
    fits = (F.col("row_a") < F.col("row_b")) & (
        F.least("size_a", "size_b") >= F.lit(similarity) * F.greatest("size_a", "size_b") - F.lit(1e-9)
    )
    candidates = a.join(b, ["sig", "side"]).where(fits).select("row_a", "row_b", "side").distinct()
    texts = held.select("row_id", "side", "size", "keys")
    paired = candidates.join(texts.toDF("row_a", "side", "size_a", "keys_a"), ["row_a", "side"]).join(
        texts.toDF("row_b", "side", "size_b", "keys_b"), ["row_b", "side"]
    )
    pairs = paired.mapInArrow(_verify(similarity), "row_a bigint, row_b bigint, side int, similarity double")
    return Links(members.drop("size"), materialize(pairs, "neardup"))


def similar_pairs(links: Links, star: int = STAR) -> DataFrame:
    """Distinct ``row_id_a < row_id_b`` of similar rows.

    All pairs are given but those of more than ``star`` texts that are equal
    byte by byte: each of these is paired with the smallest one, which alone
    stands for them in pairs with other texts. No link between different texts
    is lost.
    """
    m = links.members
    few = F.col("same") <= star
    stars = m.where(~few & (F.col("row_id") > F.col("text_id"))).select(
        F.col("text_id").alias("row_a"), F.col("row_id").alias("row_b")
    )
    # every text stands for itself; those with few copies in every one of them
    stand = m.where(few | (F.col("row_id") == F.col("text_id")))
    several = stand.where("copies > 1")
    x = several.select("side", "class_id", F.col("row_id").alias("row_a"))
    y = several.select("side", "class_id", F.col("row_id").alias("row_b"))
    equal = x.join(y, ["side", "class_id"]).where("row_a < row_b").select("row_a", "row_b")
    p = stand.select("side", F.col("class_id").alias("row_a"), F.col("row_id").alias("a"))
    q = stand.select("side", F.col("class_id").alias("row_b"), F.col("row_id").alias("b"))
    across = links.pairs.join(p, ["side", "row_a"]).join(q, ["side", "row_b"]).select(F.col("a").alias("row_a"), F.col("b").alias("row_b"))
    every = equal.unionByName(stars).unionByName(across)
    return every.select(
        F.least("row_a", "row_b").alias("row_id_a"), F.greatest("row_a", "row_b").alias("row_id_b")
    ).distinct()


def class_links(links: Links) -> DataFrame:
    """One row per row and field: ``side, row_id, class_id, copies, links`` (similar other classes)."""
    ends = links.pairs.select("side", F.col("row_a").alias("class_id")).unionByName(
        links.pairs.select("side", F.col("row_b").alias("class_id"))
    )
    counted = ends.groupBy("side", "class_id").agg(F.count("*").alias("links"))
    return links.members.join(counted, ["side", "class_id"], "left").select(
        "side", "row_id", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links")
    )
