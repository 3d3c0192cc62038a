"""Column summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _summary(df: DataFrame, columns: Sequence[str], extremes: str) -> DataFrame:
    """One row per column in one aggregation pass; ``extremes`` is the type of min and max."""

    def of(c: str) -> list:
        number = isinstance(df.schema[c].dataType, T.NumericType)
        moments = [(f(c) if number else F.lit(None)).cast("double") for f in (F.mean, F.stddev)]
        return [F.count(c), *moments, F.min(c).cast(extremes), F.max(c).cast(extremes)]

    names = ("n", "mean", "stddev", "min", "max")
    rows = [F.struct(F.lit(c).alias("column"), *(v.alias(n) for n, v in zip(names, of(c)))) for c in columns]
    return df.agg(F.array(*rows).alias("s")).select(F.inline("s"))


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null count, mean, sample deviation, min and max of numeric columns, as numbers."""
    return _summary(df, columns, "double")


def column_summary_mixed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The same for columns of any atomic type, all of them unless named.

    ``min`` and ``max`` are text; text, dates and the like have no mean and deviation.
    """
    return _summary(df, df.columns if columns is None else columns, "string")
