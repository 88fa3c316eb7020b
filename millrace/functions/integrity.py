"""Canaries, contamination checks and sealed parameters, as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the name space of object identifiers (RFC 4122).
NAMESPACE_OID = "6ba7b8129dad11d180b400c04fd430c8"


def _little_endian_hex(seed: int) -> str:
    return seed.to_bytes(8, "little").hex()


def uuid5(name: Column) -> Column:
    """The version-5 UUID of a name under the object identifier name space."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_OID)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(F.substring(variant, -1, 1), F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def canary_id(task_id: Column, seed: int) -> Column:
    return F.concat(F.lit("CANARY-"), F.upper(uuid5(F.concat(task_id, F.lit("-" + _little_endian_hex(seed))))))


def canary_hash(canary: Column) -> Column:
    return F.sha2(canary, 256)


def contamination(output: Column, canary: Column) -> Column:
    """``struct<contaminated, canary_found, partial_match, confidence>`` of an output against its canary."""
    upper, cid = F.upper(output), F.upper(canary)
    exact = upper.contains(cid)
    hashed = output.contains(canary_hash(canary))
    pieces = F.split(F.substring(cid, 8, 36), "-")
    partial = F.exists(pieces, lambda p: (F.length(p) >= 4) & upper.contains(p))
    sure = F.when(exact, 1.0).when(hashed, 0.95).when(partial, 0.6).otherwise(0.0)
    return F.struct(
        (exact | hashed | (sure > 0.8)).alias("contaminated"),
        exact.alias("canary_found"),
        partial.alias("partial_match"),
        sure.alias("confidence"),
    )


def combined_score(process_score: Column, found: Column) -> Column:
    """A process score weighed down by contamination."""
    s = process_score * F.when(found["contaminated"], 0.1).when(found["partial_match"], 0.7).otherwise(1.0)
    s = s * F.when(found["confidence"] > 0.5, 1.0 - (found["confidence"] - 0.5) * 0.4).otherwise(1.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), s))


def _xor(hexed: Column, key: str) -> Column:
    """Hex digits xored byte by byte with a repeated key; four bytes at a time would not be shorter."""
    k = key.encode().hex()
    n = len(k) // 2
    at = lambda i: F.conv(F.substring(hexed, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
    key_at = lambda i: F.conv(F.substring(F.lit(k), (i % n) * 2 + 1, F.lit(2)), 16, 10).cast("int")
    steps = F.sequence(F.lit(0), (F.length(hexed) / 2).cast("int") - 1)
    return F.array_join(
        F.transform(steps, lambda i: F.lpad(F.hex(at(i).bitwiseXOR(key_at(i)).cast("bigint")), 2, "0")), ""
    )


def seal(text: Column, key: str) -> Column:
    """Text xored with a cyclic key, in base 64. An empty key is an error; empty text stays empty."""
    if not key:
        raise ValueError("the key is empty")
    return F.when(text == "", "").otherwise(F.base64(F.unhex(_xor(F.hex(F.encode(text, "UTF-8")), key))))


def unseal(sealed: Column, key: str) -> Column:
    """The inverse of :func:`seal`."""
    if not key:
        raise ValueError("the key is empty")
    return F.when(sealed == "", "").otherwise(F.decode(F.unhex(_xor(F.hex(F.unbase64(sealed)), key)), "UTF-8"))
