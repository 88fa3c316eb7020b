"""Problem 7: a sample whose category shares match given targets.

Counts per combination of categories are the only thing that reaches the
driver: at most the product of the target categories of all dimensions, and
one more in each for rows of no category. The integer quotas are worked out
there; the rows are chosen by bisecting on a random key, so no category is
sorted or collected.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bisect import beyond, cutoffs
from millrace.runtime import fold

OTHER = "\x1e"  # stands for NULL, empty and unlisted categories


@dataclass(frozen=True)
class Target:
    target_id: int
    dim: str
    category: str
    share: float
    floor: int


def read_targets(targets: DataFrame) -> list[Target]:
    """The rows of the target table; one per category, so the driver can hold them."""
    rows = targets.select("target_id", "dim", fold("category").alias("category"), "target_share", "min_rows").collect()
    return [Target(r[0], r[1], r[2], float(r[3] or 0.0), int(r[4] or 0)) for r in rows]


def largest_remainder(
    shares: Mapping[str, float], total: int, floors: Mapping[str, int], caps: Mapping[str, int]
) -> dict[str, int]:
    """Integer quotas that follow ``shares``, never below a floor nor above what is available.

    Categories pinned by a floor or a cap leave the rest to be shared anew. The
    result sums to ``total`` wherever the caps allow it.
    """
    lows = {k: min(floors.get(k, 0), caps.get(k, 0)) for k in shares}
    quota: dict[str, int] = {}
    free, left = {k: s for k, s in shares.items() if s > 0 or lows[k]}, total
    while free:
        weight = sum(free.values())
        ideal = {k: left * s / weight if weight else 0.0 for k, s in free.items()}
        # caps first: what they leave over may lift others above their floors
        pinned = {k: caps.get(k, 0) for k in free if ideal[k] >= caps.get(k, 0)}
        pinned = pinned or {k: lows[k] for k in free if ideal[k] < lows[k]}
        if not pinned:
            base = {k: math.floor(x) for k, x in ideal.items()}
            spare = max(0, round(left - sum(base.values())))
            for k in sorted(free, key=lambda k: (base[k] - ideal[k], k))[:spare]:
                base[k] += 1
            return {**{k: 0 for k in shares}, **quota, **base}
        quota |= pinned
        left = max(0, left - sum(pinned.values()))
        free = {k: s for k, s in free.items() if k not in pinned}
    return {**{k: 0 for k in shares}, **quota}


def _sums(cells: Mapping[tuple[str, ...], float], d: int) -> dict[str, float]:
    out: dict[str, float] = {}
    for c, v in cells.items():
        out[c[d]] = out.get(c[d], 0) + v
    return out


def cell_quotas(
    counts: Mapping[tuple[str, ...], int], margins: Sequence[Mapping[str, int]], rounds: int = 200
) -> dict[tuple[str, ...], int]:
    """Quotas of category combinations whose margins follow the given ones and never exceed them.

    Iterative proportional fitting within what each combination holds, then
    rounding by largest remainder where every dimension has room.
    """
    x = {c: float(n) for c, n in counts.items()}
    for turn in range(rounds + 1):
        for d, margin in enumerate(margins):
            sums = _sums(x, d)
            for c in x:
                ratio = margin.get(c[d], 0) / sums[c[d]] if sums[c[d]] else 0.0
                # what the margins cannot hold together is cut back at the end
                x[c] = min(counts[c], x[c] * (ratio if turn < rounds else min(1.0, ratio)))
    out = {c: math.floor(v + 1e-9) for c, v in x.items()}
    order = sorted(x, key=lambda c: (out[c] - x[c], c))
    for most in (1, max(counts.values(), default=0)):
        _fill(out, counts, margins, order, most)
    return out


def _fill(
    quotas: dict[tuple[str, ...], int],
    counts: Mapping[tuple[str, ...], int],
    margins: Sequence[Mapping[str, int]],
    order: Sequence[tuple[str, ...]],
    most: int,
) -> None:
    """Raise the quotas of combinations, in order and by up to ``most`` each, while every margin they count in has room."""
    room = [{k: n - sums.get(k, 0) for k, n in m.items()} for m, sums in ((m, _sums(quotas, d)) for d, m in enumerate(margins))]
    for c in order:
        listed = [(d, k) for d, k in enumerate(c) if k != OTHER]
        more = min(most, counts[c] - quotas.get(c, 0), *[room[d].get(k, 0) for d, k in listed]) if listed else 0
        if more > 0:
            quotas[c] = quotas.get(c, 0) + more
            for d, k in listed:
                room[d][k] -= more


def allocate(
    counts: Mapping[tuple[str, ...], int],
    shares: Sequence[Mapping[str, float]],
    floors: Sequence[Mapping[str, int]],
    total: int,
) -> dict[tuple[str, ...], int]:
    """Quotas of category combinations for ``total`` listed rows in every dimension.

    Rows listed in all dimensions come first; what a category then lacks is
    filled from rows that are ``OTHER`` elsewhere. What cannot be filled either
    goes to the other categories of its dimension, in rows listed in all.
    """
    whole = {c: n for c, n in counts.items() if OTHER not in c}
    part = sorted(counts.keys() - whole.keys(), key=lambda c: (c.count(OTHER), c))
    caps = [_sums(counts, d) for d in range(len(shares))]
    best: dict[tuple[str, ...], int] = {}
    aims: list[dict[str, int]] = []
    for _ in range(2 * sum(map(len, shares)) + 1):
        margins = [largest_remainder(s, total, f, {k: c.get(k, 0) for k in s}) for s, f, c in zip(shares, floors, caps)]
        aims = aims or margins
        quotas = cell_quotas(whole, margins)
        _fill(quotas, counts, aims, part, total)
        if _listed(quotas) > _listed(best):
            best = quotas
        got = [_sums(quotas, d) for d in range(len(shares))]
        short = [{k: g.get(k, 0) for k, n in m.items() if g.get(k, 0) < n} for g, m in zip(got, margins)]
        if not any(short):
            break
        first = next(d for d, lacking in enumerate(short) if lacking)
        caps[first] |= short[first]
    return best


def _listed(quotas: Mapping[tuple[str, ...], int]) -> int:
    return sum(n * (len(c) - c.count(OTHER)) for c, n in quotas.items())


@dataclass(frozen=True)
class Plan:
    dims: tuple[str, ...]
    rows: int
    available: dict[tuple[str, str], int]
    quotas: dict[tuple[str, ...], int]
    wanted: list[dict[str, int]]  # per dimension the quotas by largest remainder
    targets: list[Target]


def _categories(rows: DataFrame, targets: Sequence[Target], dims: Sequence[str]) -> DataFrame:
    cols = []
    for d in dims:
        known = [t.category for t in targets if t.dim == d]
        cols.append(F.when(fold(d).isin(known), fold(d)).otherwise(OTHER).alias(f"cat_{d}"))
    return rows.select(*cols, F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))


def plan(rows: DataFrame, targets: DataFrame, rate: float = 0.3) -> Plan:
    """Count the categories and allocate quotas for a sample of ``rate * rows``."""
    wanted = read_targets(targets)
    dims = tuple(sorted({t.dim for t in wanted}))
    cats = [f"cat_{d}" for d in dims]
    counted = _categories(rows, wanted, dims).groupBy(*cats).agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in counted)
    available: dict[tuple[str, str], int] = {}
    for r, (d, c) in itertools.product(counted, zip(dims, cats)):
        if r[c] != OTHER:
            available[d, r[c]] = available.get((d, r[c]), 0) + r["n"]
    shares = [{t.category: t.share for t in wanted if t.dim == d} for d in dims]
    floors = [{t.category: t.floor for t in wanted if t.dim == d} for d in dims]
    cells = {tuple(r[c] for c in cats): r["n"] for r in counted}
    size = math.floor(rate * total)
    caps = [_sums(cells, d) for d in range(len(dims))]
    quotas = [largest_remainder(s, size, f, {k: c.get(k, 0) for k in s}) for s, f, c in zip(shares, floors, caps)]
    return Plan(dims, total, available, allocate(cells, shares, floors, size), quotas, wanted)


def report(rows: DataFrame, targets: DataFrame, rate: float = 0.3) -> DataFrame:
    """Per target what it needs, what there is, its quota, what is sampled, and whether it can be and is met.

    A target needs ``max(min_rows, target_share * (rate * rows))`` rows, not
    rounded. It is ``unmet`` if there are fewer, and ``missed`` if the sample
    holds fewer, be it by a quota rounded down. ``shortfall`` is what the sample
    lacks of the quota by largest remainder, where the dimensions cannot all be
    had together. Categories are compared trimmed
    and in lower case; NULL, empty and unlisted ones belong to no target.
    """
    made = plan(rows, targets, rate)
    out = []
    for t in made.targets:
        need = max(float(t.floor), t.share * (rate * made.rows))
        have = made.available.get((t.dim, t.category), 0)
        at = made.dims.index(t.dim)
        got = sum(q for c, q in made.quotas.items() if c[at] == t.category)
        quota = made.wanted[at].get(t.category, 0)
        out.append((t.target_id, t.dim, t.category, need, have, quota, got, max(0, quota - got), have < need, got < need))
    return rows.sparkSession.createDataFrame(
        out,
        "target_id int, dim string, category string, needed double, available bigint, quota bigint, sampled bigint, shortfall bigint, unmet boolean, missed boolean",
    )


def sample(rows: DataFrame, targets: DataFrame, rate: float = 0.3, *, key: str = "instance_id", seed: int = 7) -> DataFrame:
    """The sample itself: all columns of the chosen rows.

    In every combination of categories the rows with the smallest random keys
    (a seeded hash of ``key``) are taken. A row with a category in only some
    dimensions is taken where that category is short otherwise, so the sample
    may hold more than ``rate * rows`` rows, but not of any dimension's
    categories. Rows outside all of them are never sampled; an empty table
    gives an empty sample.
    """
    made = plan(rows, targets, rate)
    cell = F.concat_ws("\x1f", *[F.col(f"cat_{d}") for d in made.dims])
    inside = _categories(rows, made.targets, made.dims)
    text = F.coalesce(F.col(f"row.`{key}`").cast("string"), F.lit(""))
    keyed = inside.select(
        cell.alias("cell"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), text), 2).alias("draw"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), text), 2).alias("tie"),
        "row",
    )
    quotas = rows.sparkSession.createDataFrame(
        [("\x1f".join(c), q) for c, q in made.quotas.items() if q > 0], "cell string, quota bigint"
    )
    cuts = cutoffs(keyed.drop("row"), "cell", ("draw", "tie"), quotas)
    chosen = keyed.join(F.broadcast(quotas), "cell").join(cuts, "cell", "left").where(~beyond(("draw", "tie")))
    return chosen.select("row.*")
