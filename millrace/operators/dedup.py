"""At-least-once deliveries: exact de-duplication with quotient hash tables.

A message is identified by its event number, repository and pull number. The
event number is fixed-width (64 bit), so a keyed Feistel network *permutes* it:
no two numbers share an image and the number can be read back. The upper bits
of the image (the quotient) choose the shard, the lower bits (the remainder) are
stored in full beside the other key columns, so a slot never matches falsely as
a Bloom filter or a truncated fingerprint would. Spark's hash aggregate is the
table of a shard: copies are combined before the shuffle, so a message that
holds a third of all rows reaches its shard as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.runtime import fold, utrim

ROUNDS = 2
QUOTIENT_BITS = 20
_LOW32 = 0xFFFFFFFF


def event_number(c: Column | str) -> Column:
    """The number inside an event id, whatever surrounds it.

    Leading zeros do not count. NULL for ids without digits or with several
    runs of them (which need not be a number at all), and for numbers that do
    not fit into 64 bits.
    """
    c = F.col(c) if isinstance(c, str) else c
    digits = F.regexp_extract(c, r"^[^0-9]*([0-9]+)[^0-9]*\z", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def permute64(c: Column) -> Column:
    """A bijection of the 64-bit integers (balanced Feistel network)."""
    left, right = F.shiftrightunsigned(c, 32), c.bitwiseAND(F.lit(_LOW32))
    for r in range(ROUNDS):
        mix = F.xxhash64(right, F.lit(r)).bitwiseAND(F.lit(_LOW32))
        left, right = right, left.bitwiseXOR(mix)
    return F.shiftleft(left, 32).bitwiseOR(right)


def unpermute64(c: Column) -> Column:
    """The inverse of :func:`permute64`."""
    left, right = F.shiftrightunsigned(c, 32), c.bitwiseAND(F.lit(_LOW32))
    for r in reversed(range(ROUNDS)):
        mix = F.xxhash64(left, F.lit(r)).bitwiseAND(F.lit(_LOW32))
        left, right = right.bitwiseXOR(mix), left
    return F.shiftleft(left, 32).bitwiseOR(right)


KEY = ("quotient", "remainder", "name", "alone", "repository", "pull_number")


def _slots(events: DataFrame) -> DataFrame:
    """Every row with its place in the tables.

    Ids with digits that are no single number (UUIDs, more than 64 bits) are stored by
    their whole trimmed text in ``name``; rows whose id has no digit have a place of their own each.
    """
    image = permute64(event_number("id"))
    named = F.coalesce(F.col("id").rlike("[0-9]"), F.lit(False))
    return events.select(
        F.shiftrightunsigned(image, 64 - QUOTIENT_BITS).alias("quotient"),
        image.bitwiseAND(F.lit((1 << (64 - QUOTIENT_BITS)) - 1)).alias("remainder"),
        F.when(image.isNull() & named, utrim("id")).alias("name"),
        F.when(~named, F.monotonically_increasing_id()).alias("alone"),
        fold("repository").alias("repository"),
        F.col("pull_number"),
        F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("row"),
    )


def _number() -> Column:
    image = F.shiftleft(F.col("quotient"), 64 - QUOTIENT_BITS).bitwiseOR(F.col("remainder"))
    return unpermute64(image).alias("event_no")


def message_counts(events: DataFrame) -> DataFrame:
    """One row per message: ``event_no, repository, pull_number, copies``.

    The three key parts must all agree; NULL agrees with NULL. Rows whose id
    holds no number are no case and left out. An empty table gives no rows;
    extra columns are ignored.
    """
    slots = _slots(events).drop("row").where(F.col("remainder").isNotNull())
    tables = slots.groupBy("quotient", "remainder", "repository", "pull_number").agg(F.count("*").alias("copies"))
    return tables.select(_number(), "repository", "pull_number", "copies")


def _tables(events: DataFrame, order_by: tuple[str, ...]) -> DataFrame:
    """The filled tables: per slot the row that was inserted and how many came."""
    cols = [F.col(f"row.`{c}`") for c in events.columns]
    hashed = F.to_json("row") if any(f.dataType.typeName() in ("map", "variant") for f in events.schema.fields) else F.struct(*cols)
    rank = F.struct(*[x for c in order_by for x in (F.col(f"row.`{c}`").isNull(), F.col(f"row.`{c}`"))], F.xxhash64(hashed))
    return _slots(events).groupBy(*KEY).agg(F.min_by("row", rank).alias("row"), F.count("*").alias("copies"))


def keep_one(events: DataFrame, order_by: tuple[str, ...] = ("ingested_at", "batch_id")) -> DataFrame:
    """Exactly one copy of each message, with all columns as delivered.

    The first delivery by ``order_by`` (NULL last) stays; among equal ones the
    choice falls on the smallest hash of the whole row. Ids with digits that
    are no single number count as they are written, but for blanks around them;
    rows whose id has no digit cannot be told apart and all stay.
    """
    return _tables(events, order_by).select("row.*")


def kept_messages(events: DataFrame, order_by: tuple[str, ...] = ("ingested_at", "batch_id")) -> DataFrame:
    """One row per message with a number: ``event_no, repository, pull_number, copies`` and what it was ordered by.

    The tables of :func:`keep_one` over the columns they need, so no text is moved.
    """
    narrow = events.select("id", "repository", "pull_number", *order_by)
    kept = _tables(narrow, order_by).where(F.col("remainder").isNotNull())
    return kept.select(_number(), "repository", "pull_number", "copies", *[F.col(f"row.`{c}`").alias(c) for c in order_by])
