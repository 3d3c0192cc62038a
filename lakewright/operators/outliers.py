"""Dropping unusable and extreme amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.operators.quantile import narrowed_quantiles, quantile


def keep_positive(df: DataFrame, amount: str) -> DataFrame:
    """Rows with a positive amount and no null in any column."""
    return df.where(F.col(amount) > 0).dropna(how="any")


def trim_above_quantile(
    df: DataFrame,
    amount: str,
    q: float = 0.999,
    method: str = "narrow",
) -> DataFrame:
    """Rows strictly below the exact quantile; the largest always goes, a single row too.

    ``df`` is evaluated again for the quantile, several times: stage
    it first if it is more than a scan.
    """
    return df.where(F.col(amount) < quantile(df, amount, q, method)).dropna(how="any")


def trim_above_group_quantile(df: DataFrame, by: Sequence[str], amount: str, q: float = 0.999) -> DataFrame:
    """As ``trim_above_quantile``, with an exact quantile for each group; a fixed number of passes for all of them."""
    cuts = narrowed_quantiles(df, by, amount, q).select(F.struct(*by).alias("_group"), F.col("value").alias("_cut"))
    kept = df.withColumn("_group", F.struct(*by)).join(cuts, "_group").where(F.col(amount) < F.col("_cut"))
    return kept.select(*df.columns).dropna(how="any")
