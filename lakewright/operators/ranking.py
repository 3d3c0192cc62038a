"""Totals by group with rank order and percent of the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def share_by_group(df: DataFrame, group: str, amount: str) -> DataFrame:
    """``group, sum, percent``: the sum of ``amount`` and its percent of all groups together.

    The total is a scalar subquery over the same grouped sums. Both uses share one
    shuffle of partial sums, and no group of any number passes through a single task.
    A zero total gives null percents.
    """
    sums = df.groupBy(group).agg(F.sum(amount).alias("sum"))
    total = sums.agg(F.sum("sum")).scalar()
    return sums.select(
        group, "sum", F.try_divide((F.col("sum") * 100).cast("double"), total.cast("double")).alias("percent")
    )


def rank_order(df: DataFrame, group: str) -> DataFrame:
    """Largest sum first; equal sums by group name, so that the order is always the same."""
    return df.orderBy(F.desc("sum"), F.asc(group))


def top_groups(df: DataFrame, group: str, k: int) -> DataFrame:
    """The ``k`` largest groups (planned as take-ordered, without a full sort)."""
    return rank_order(df, group).limit(k)
