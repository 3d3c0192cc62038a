"""Which source objects are still to be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.functions.epoch import MILLIS_PER_DAY


def resume_point(ledger: DataFrame, look_back_millis: int = MILLIS_PER_DAY) -> DataFrame:
    """One row: ``last_ts`` and ``resume_after``, the newest object less the look-back."""
    last = ledger.agg(F.max("file_ts").alias("last_ts"))
    return last.select("last_ts", (F.col("last_ts") - look_back_millis).alias("resume_after"))


def pending_objects(
    listing: DataFrame,
    ledger: DataFrame,
    look_back_millis: int | None = None,
    exclude: DataFrame | None = None,
    key: str = "path",
) -> DataFrame:
    """Objects that are not in the ledger, however old.

    Both inputs have ``path`` (or another ``key``) and ``file_ts``; an empty ledger leaves everything pending. With a look-back,
    only objects newer than the resume point are looked at, and only that part of the ledger takes part in the join:
    cheaper, but an older object that turns up late is left to a later run without one. Seen objects are judged by
    the ledger's own timestamps, never by the dates of the records inside.
    """
    if look_back_millis is not None:
        after = resume_point(ledger, look_back_millis).select("resume_after").scalar()
        listing = listing.where(F.coalesce(F.col("file_ts") > after, F.lit(True)))
        ledger = ledger.where(F.col("file_ts") > after)
    seen = ledger.select(key)
    if exclude is not None:
        seen = seen.unionByName(exclude.select(key))
    return listing.join(seen, key, "left_anti")
