"""Approximate quantiles of any range of days from sketches stored once per day.

A sketch (KLL) is a few tens of kilobytes whatever the number of rows it stands for, and sketches merge into one of the same
size. Kept beside a table, partitioned by date like it, they answer for any range of dates without a second scan of the rows.
Where the exact value is wanted, ``quantile`` gives it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 4000  # values a sketch keeps, about; the more, the smaller the error


def rank_error(size: int = SIZE) -> float:
    """By how much of all rows a quantile's rank may be off, in 99 of 100 sketches; the published bound of the method."""
    return 2.296 / size**0.9723


def value_sketches(df: DataFrame, by: Sequence[str], column: str, size: int = SIZE) -> DataFrame:
    """``by, n, low, high, sketch`` of each group that has a value.

    Nulls and NaN are not counted. Spark sketches each task's part of a group and merges these, so a hot group is in no one task.
    A group of fewer than ``size`` values is held whole and its quantiles are values of exact rank. Null keys form a group.
    """
    values = df.select(*by, F.col(column).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    return values.groupBy(*by).agg(
        F.count("_x").alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high"), F.kll_sketch_agg_double("_x", size).alias("sketch")
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """The same columns with the sketches of each ``by`` group, or of all, merged; merged sketches merge further. Of no sketches there is none."""
    merged = F.kll_merge_agg_double("sketch", size).alias("sketch")
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), merged).where("n > 0")


def sketched_quantiles(sketches: DataFrame, qs: Sequence[float]) -> DataFrame:
    """A row for each sketch and each of ``qs``, with ``q`` and ``value``: a value of the data whose rank is off by ``rank_error`` or so.

    The smallest and the largest value are exact.
    """
    if not all(0.0 <= q <= 1.0 for q in qs):
        raise ValueError("q must lie between 0 and 1")
    wanted = F.array(*(F.lit(float(q)) for q in qs))
    pairs = F.arrays_zip(wanted.alias("q"), F.kll_sketch_get_quantile_double("sketch", wanted).alias("value"))
    return sketches.withColumn("_pair", F.explode(pairs)).select(*sketches.columns, "_pair.q", "_pair.value")
