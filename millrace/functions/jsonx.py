"""Recovering JSON from free text (model answers), as one Arrow UDF over a character scan."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.runtime import utrim
from millrace.sources.events import valid_object

RESULT = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("json", T.StringType()),
        T.StructField("braces", T.LongType()),
        T.StructField("brackets", T.LongType()),
    ]
)
_FENCE = re.compile(r"```([A-Za-z0-9_+-]*)[ \t]*\r?\n?(.*?)```", re.S)
_PAIRS = {"{": "}", "[": "]"}


@dataclass(frozen=True)
class Structure:
    braces: int
    brackets: int
    in_string: bool
    start: int | None

    @property
    def open(self) -> bool:
        return self.braces > 0 or self.brackets > 0 or self.in_string


def _significant(text: str, start: int = 0) -> Iterator[tuple[int, str]]:
    """Brackets outside strings; at last a quote if a string stays open."""
    quoted = skip = False
    for i in range(start, len(text)):
        c = text[i]
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in "{}[]":
            yield i, c
    if quoted:
        yield len(text), '"'


def structure(text: str) -> Structure:
    """How many brackets stay open, whether a string does, and where the first bracket opens."""
    depth = {"{": 0, "[": 0}
    start, in_string = None, False
    for i, c in _significant(text):
        if c in depth:
            start = i if start is None else start
            depth[c] += 1
        elif c == '"':
            in_string = True
        else:
            depth["{" if c == "}" else "["] -= 1
    return Structure(max(0, depth["{"]), max(0, depth["["]), in_string, start)


def closer(text: str, start: int) -> int | None:
    """Index of the bracket that closes the one at ``start``; only brackets of its kind count."""
    own, other = text[start], _PAIRS[text[start]]
    depth = 0
    for i, c in _significant(text, start):
        depth += (c == own) - (c == other)
        if c == other and depth == 0:
            return i
    return None


def _valid(text: str) -> bool:
    try:
        json.loads(text, parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c)))
    except (ValueError, RecursionError):
        return False
    return True


def _balanced(text: str, start: int) -> str | None:
    end = closer(text, start)
    piece = text[start : end + 1] if end is not None else None
    return piece if piece is not None and _valid(piece) else None


def _fenced(text: str) -> str | None:
    """From the first fence marked json if an object opens it, else from the first object in the first fence."""
    marked = next((m.group(2).strip() for m in _FENCE.finditer(text) if m.group(1) == "json"), "")
    if marked.startswith("{") and (got := _balanced(marked, 0)):
        return got
    first = _FENCE.search(text)
    at = first.group(2).find("{") if first else -1
    return _balanced(first.group(2), at) if first and at >= 0 else None


def _largest(text: str) -> str | None:
    """The longest valid object; of equal ones the later."""
    best: str | None = None
    at = text.find("{")
    while at >= 0:
        got = _balanced(text, at)
        if got and (best is None or len(got.encode()) >= len(best.encode())):
            best = got
        at = text.find("{", at + (len(got) if got else 1))
    return best


def _whole_or_cut(text: str, start: int) -> tuple[str, str, int, int] | None:
    if got := _balanced(text, start):
        return "success", got, 0, 0
    s = structure(text[start:])
    return ("truncated", text[start:], s.braces, s.brackets) if s.open else None


def extract(content: str | None) -> tuple[str, str | None, int, int]:
    """``status, json, unclosed braces, unclosed brackets``; status is success, truncated or not_found.

    Looked for in this order: fenced blocks, a text that begins with JSON, the
    largest valid object, the first object, the first list, whatever lies
    between the last braces, and JSON cut off at the end. NULL has none.
    """
    text = (content or "").strip()
    if got := _fenced(text):
        return "success", got, 0, 0
    if text[:1] in ("{", "[") and (res := _whole_or_cut(text, 0)):
        return res
    if got := _largest(text):
        return "success", got, 0, 0
    for opener in "{[":
        at = text.find(opener)
        if at >= 0 and (res := _whole_or_cut(text, at)):
            return res
    a, b = text.rfind("{"), text.rfind("}")
    if 0 <= a < b and _valid(text[a : b + 1]):
        return "success", text[a : b + 1], 0, 0
    s = structure(text)
    if s.start is not None and s.open:
        return "truncated", text[s.start :], s.braces, s.brackets
    return "not_found", None, 0, 0


def recovered(content: Column) -> Column:
    """:func:`extract` of a column. Texts that are one whole object are told by the engine itself; Python sees only the others."""
    text = utrim(content)
    whole = valid_object(text)
    done = F.struct(F.lit("success").alias("status"), text.alias("json"), F.lit(0).cast("bigint").alias("braces"), F.lit(0).cast("bigint").alias("brackets"))
    return F.when(whole, done).otherwise(extract_json(F.when(~whole, content)))


@F.pandas_udf(RESULT)
def extract_json(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([extract(c) for c in content], columns=["status", "json", "braces", "brackets"])
