"""Objects that several folders hold under the same key, each taken once.

A key is what of a path lies below its folder. Copies of an object have equal names, so the time in the name is one too. A stream keeps
the keys of one delay behind the newest object and drops a key it holds; an object older than that is not looked at by
the stream and left to the join with the ledger (``plans.backfill``), which knows all keys ever read. So nothing is read twice,
nothing is lost, and what a stream remembers does not grow with time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.sources.listing import strip_root

DELAY = "1 day"
KEY, _TIME = "_object_key", "_object_time"


def object_key(path: Column, roots: Sequence[str]) -> Column:
    """What lies below the innermost of ``roots`` that holds the path; a path outside all of them as it is."""
    key = path
    for root in sorted(roots, key=len):  # the longest that fits is tried first
        key = F.when(F.startswith(path, F.lit(root.rstrip("/") + "/")), strip_root(path, root)).otherwise(key)
    return key


def first_of_each(objects: DataFrame, roots: Sequence[str], delay: str = DELAY) -> DataFrame:
    """Of a stream with ``path`` and ``file_ts``, the first row of each key; a row too late for ``delay`` goes.

    The time that counts is that in the name, or the present if the name lies in the future: one odd name must not make all others late.
    """
    millis = F.least("file_ts", F.unix_millis(F.current_timestamp()))
    timed = objects.withColumns({KEY: object_key(F.col("path"), roots), _TIME: F.timestamp_millis(millis)})
    return timed.withWatermark(_TIME, delay).dropDuplicatesWithinWatermark([KEY]).select(*objects.columns)


def one_of_each(objects: DataFrame, roots: Sequence[str]) -> DataFrame:
    """Of a batch with ``path``, the row of each key with the smallest path; with the key as a further column."""
    row = F.struct("path", *(c for c in objects.columns if c != "path"))
    kept = objects.groupBy(object_key(F.col("path"), roots).alias(KEY)).agg(F.min_by(row, "path").alias("_row"))
    return kept.select(*(F.col("_row")[c].alias(c) for c in objects.columns), KEY)
