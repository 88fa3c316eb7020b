"""The token measure of problems 8 and 9."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the public WordPunct pattern, letters of every script being \w.
WORD_PUNCT = r"(?U)\w+|[^\w\s]+"


def token_count(text: Column | str) -> Column:
    """WordPunct tokens of a text; NULL counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PUNCT)), F.lit(0)).cast("bigint")
