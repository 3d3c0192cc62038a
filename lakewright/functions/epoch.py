"""Epoch-time column functions, all JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLIS_PER_DAY = 86_400_000
SECONDS_PER_DAY = 86_400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_epoch_millis(millis: Column | str) -> Column:
    """Milliseconds since 1970 as a timestamp. Unsigned 64-bit values arrive as decimals."""
    return F.timestamp_millis(_col(millis).cast("bigint"))


def epoch_day(epoch: Column | str, divisor: int = MILLIS_PER_DAY) -> Column:
    """Date of an epoch value given the units per day; null counts as day 0.

    A day number beyond 32 bits gives null, for the caller to quarantine.
    """
    value = F.coalesce(_col(epoch).cast("decimal(23,0)"), F.lit(0))
    days = (value - F.pmod(value, F.lit(divisor))) / F.lit(divisor)
    return F.date_from_unix_date(days.try_cast("int"))
