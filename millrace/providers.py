"""Answers from outside (models, services, containers) as tables or column builders.

A stage that needs an answer takes a provider: a function from rows with a key
to ``key, answer`` rows. Recorded answers are a table; a rule is a Column; a
service is called by partition, in Arrow batches. Stages are chained by joining
the answers on, so no plan ever waits for a call inside an expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Provider = Callable[[DataFrame, Sequence[str]], DataFrame]


def recorded(answers: DataFrame) -> Provider:
    """Answers of a table that has the key columns and ``answer``; the smallest of several."""
    return lambda rows, key: answers.groupBy(*key).agg(F.min("answer").alias("answer"))


def by_rule(answer: Column) -> Provider:
    """A deterministic answer from the row itself."""
    return lambda rows, key: rows.select(*key, answer.alias("answer")).dropDuplicates(list(key))


def by_call(call: Callable[[pd.DataFrame], pd.Series], columns: Sequence[str], kind: str = "string") -> Provider:
    """Answers of a function on batches of ``columns``; a batch that fails gives NULL answers."""

    def provide(rows: DataFrame, key: Sequence[str]) -> DataFrame:
        asked = rows.select(*key, *columns).dropDuplicates(list(key))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                try:
                    answer = call(b[list(columns)])
                except Exception:  # noqa: BLE001 - whatever an outside service raises, its rows stay without an answer
                    answer = pd.Series([None] * len(b))
                yield b[list(key)].assign(answer=list(answer))

        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.select(*key).schema.fields)
        return asked.mapInPandas(run, f"{fields}, answer {kind}")

    return provide


def answered(rows: DataFrame, key: Sequence[str], provider: Provider, name: str, default: Column | None = None, *, keep: bool = True) -> DataFrame:
    """``rows`` with the provider's answer as ``name``; without one the default, or with ``keep=False`` no row."""
    got = provider(rows, key).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("answer").alias(name))
    on = None
    for i, k in enumerate(key):
        c = rows[k].eqNullSafe(F.col(f"_k{i}"))
        on = c if on is None else on & c
    out = rows.join(got, on, "left" if keep else "inner").drop(*[f"_k{i}" for i in range(len(key))])
    return out.withColumn(name, F.coalesce(F.col(name), default)) if default is not None else out
