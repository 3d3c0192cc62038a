"""Exact interpolated quantile without gathering the values anywhere.

Spark's own ``percentile`` is exact too, but keeps every distinct value in a map that
one task merges at the end, which is impossible for large input.
Here each pass counts rows per value interval, keeps the interval that holds the wanted
rank and looks only inside it in the next pass. A pass shuffles interval counts, never
rows, and hot values are merged before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakewright.scratch import stage

_LOG_STEPS = 64  # first pass: 64 intervals per factor e, at most about 190,000 overall
_LINEAR_STEPS = 4096  # later passes: equal intervals of the one kept
_SMALL_COUNT = 50_000  # rows from which the last pass may list the distinct values


def _log_interval(x: Column) -> Column:
    """Number of a value's interval on a signed logarithmic scale; never decreases with x."""
    size = F.least(F.log(F.abs(x)) + 800.0, F.lit(2000.0)) * _LOG_STEPS  # logs lie in -745..710
    return F.when(x == 0, F.lit(0.0)).when(x < 0, -F.floor(size) - 1).otherwise(F.floor(size) + 1).cast("bigint")


def _linear_interval(x: Column, low: float, high: float) -> Column:
    """Number of a value's interval among equal parts of low..high; never decreases with x."""
    return F.floor((x - low) / (high - low) * _LINEAR_STEPS).cast("bigint")


def _counts() -> list[Column]:
    return [F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")]


def _histogram(values: DataFrame, interval: Column) -> DataFrame:
    """Rows, smallest and largest value per interval, with the rows before it and the next value."""
    counted = values.groupBy(interval.alias("i")).agg(*_counts())
    order = Window.orderBy("i")  # over the interval counts only: their number is bounded
    return counted.select(
        "n",
        "low",
        "high",
        (F.sum("n").over(order) - F.col("n")).alias("before"),
        F.lead("low").over(order).alias("next"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )


def narrowed_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """The quantile by interval counting; runs a few passes now and returns the value.

    Each pass brings one row of the histogram to the driver. The kept interval is 1/64 of
    the value's magnitude after the first pass and 4096 times narrower after each further
    one: after three of those it holds some thousand doubles, whatever the data. The last
    pass counts each distinct value, once so few values or few rows are left.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must lie between 0 and 1")
    # both zeros are one value, as they are to Spark's ordering
    values = (
        df.select(F.col(column).cast("double").alias("x"))
        .where("x is not null")
        .select(F.when(F.col("x") == 0, F.lit(0.0)).otherwise(F.col("x")).alias("x"))
    )
    position, rank, skipped, following = None, None, 0, None
    histogram = _histogram(values, _log_interval(F.col("x")))
    wanted = F.floor(F.lit(q) * (F.col("total") - 1))
    for narrower in range(5):
        row = histogram.where((F.col("before") <= wanted) & (wanted < F.col("before") + F.col("n"))).first()
        if row is None:
            return None
        if position is None:
            position = q * (row.total - 1)
            rank = math.floor(position)
        skipped += row.before
        following = row.next if row.next is not None else following
        if row.low == row.high or math.isnan(row.low):
            break
        inside = values.where(F.col("x").between(F.lit(row.low), F.lit(row.high)))
        few = row.n <= _SMALL_COUNT or narrower >= 3 or not math.isfinite(row.high - row.low)
        histogram = _histogram(inside, F.col("x") if few else _linear_interval(F.col("x"), row.low, row.high))
        wanted = F.lit(rank - skipped)
    lower = row.low
    if position == rank:  # the value itself, whatever comes after it
        return lower
    upper = lower if rank + 1 < skipped + row.n or following is None else following
    if lower == upper:
        return lower
    return (rank + 1 - position) * lower + (position - rank) * upper


def narrowed_quantiles(df: DataFrame, by: Sequence[str], column: str, q: float) -> DataFrame:
    """``by`` and ``value``: the quantile of each group that has a value that is not null, by the same interval counting.

    All groups are narrowed in the same passes, so the number of scans does not depend on how many there are: five at most. What is
    known of a group, its interval and the rows before it, is one row of a small written table, which each pass joins with the
    values. A group's counts are added up before they are shuffled, a hot group's too. Null keys form a group.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must lie between 0 and 1")
    x = F.col(column).cast("double")
    values = df.select(F.struct(*by).alias("g"), F.when(x == 0, F.lit(0.0)).otherwise(x).alias("x")).where("x is not null")
    counted = values.groupBy("g", _log_interval(F.col("x")).cast("double").alias("i")).agg(*_counts())
    total = F.sum("n").over(Window.partitionBy("g"))
    wanted = {"position": q * (total - 1), "rank": F.floor(q * (total - 1)), "skipped": F.lit(0).cast("long"), "following": F.lit(None).cast("double")}
    state = stage(_kept(counted.withColumns(wanted)), "quantiles")
    found = []
    for narrower in range(1, 6):
        done = (F.col("low") == F.col("high")) | F.isnan("low")
        found.append(state.where(done))
        still = state.where(~done)
        if narrower == 5 or still.isEmpty():
            break
        width = F.col("high") - F.col("low")
        few = (F.col("n") <= _SMALL_COUNT) | F.lit(narrower >= 4) | ~(F.abs(width) < float("inf"))
        linear = F.floor((F.col("x") - F.col("low")) / width * _LINEAR_STEPS).cast("double")
        inside = values.join(still, "g").where(F.col("x").between(F.col("low"), F.col("high")))
        cells = inside.groupBy("g", "position", "rank", "skipped", "following", F.when(few, F.col("x")).otherwise(linear).alias("i"))
        state = stage(_kept(cells.agg(*_counts())), "quantiles")
    ends = reduce(DataFrame.unionByName, found)
    upper = F.when(F.col("rank") + 1 < F.col("skipped") + F.col("n"), F.col("low")).otherwise(F.coalesce("following", "low"))
    between = (F.col("rank") + 1 - F.col("position")) * F.col("low") + (F.col("position") - F.col("rank")) * upper
    exact = (F.col("position") == F.col("rank")) | (F.col("low") == upper)
    return ends.select(*(F.col("g")[c].alias(c) for c in by), F.when(exact, F.col("low")).otherwise(between).alias("value"))


def _kept(counted: DataFrame) -> DataFrame:
    """The interval of each group that holds the wanted rank, with the rows before it and the value that follows."""
    order = Window.partitionBy("g").orderBy("i")
    places = counted.withColumns({"before": F.sum("n").over(order) - F.col("n"), "next": F.lead("low").over(order)})
    left = F.col("rank") - F.col("skipped")
    return places.where((F.col("before") <= left) & (left < F.col("before") + F.col("n"))).select(
        "g", "position", "rank", (F.col("skipped") + F.col("before")).alias("skipped"), F.coalesce("next", "following").alias("following"), "n", "low", "high"
    )


def quantile(df: DataFrame, column: str, q: float, method: str = "narrow", accuracy: int = 100_000) -> Column:
    """The interpolated quantile as a column, for use in a filter or projection.

    ``narrow`` is exact at every size and computes the value now. Two others are taken only when asked for: ``builtin``,
    Spark's percentile as a scalar subquery, exact too and lazy, but with all distinct values in one
    task; and ``approx``, Spark's sketch: one pass, a value of the data whose rank is off by at most one part in
    ``accuracy``.
    """
    if method == "narrow":
        return F.lit(narrowed_quantile(df, column, q)).cast("double")
    if method == "builtin":
        return df.agg(F.percentile(F.col(column), F.lit(q))).scalar()
    if method == "approx":
        return df.agg(F.percentile_approx(F.col(column).cast("double"), q, accuracy)).scalar()
    raise ValueError("method must be 'narrow', 'builtin' or 'approx'")
