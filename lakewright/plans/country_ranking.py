"""Daily ranking of countries by transferred amount."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.operators.history import append_history, holds_date
from lakewright.operators.outliers import keep_positive, trim_above_quantile
from lakewright.operators.ranking import rank_order, share_by_group
from lakewright.scratch import stage, staged
from lakewright.sources.schema_history import path_is_missing
from lakewright.sources.tables import read_table


def located_amounts(amounts: DataFrame, places: DataFrame, entity: str, amount: str, place: str) -> DataFrame:
    """``place, amount`` of every positive amount whose entity is listed, its place possibly null.

    Catalyst broadcasts the places when they are small enough and otherwise joins by
    sort-merge, where adaptive execution splits an entity that holds many rows.
    """
    return (
        keep_positive(amounts.select(entity, amount), amount)
        .join(places.select(entity, place), entity, "inner")
        .select(place, amount)
    )


def ranked_share(
    amounts: DataFrame,
    places: DataFrame,
    entity: str = "gateway",
    amount: str = "amount",
    place: str = "country",
    trim_quantile: float = 0.999,
    write_join: bool = True,
) -> DataFrame:
    """``place, sum, percent`` over the amounts left after trimming outliers.

    Amounts without a place count for the quantile, but not for the sums.
    The join is written once, two narrow columns of it, to the shared scratch folder; the passes of the
    quantile and the sum then read that. ``write_join=False`` joins anew in each pass: for input that is already joined cheaply,
    or a copy the caller has staged and will remove.
    """
    located = located_amounts(amounts, places, entity, amount, place)
    if write_join:
        located = stage(located, "located")
    trimmed = trim_above_quantile(located, amount, trim_quantile)
    return share_by_group(trimmed, place, amount)


def daily_country_ranking(
    spark: SparkSession,
    amounts_path: str,
    places_path: str,
    history_path: str,
    day: dt.date | None = None,
    amount: str = "dc_transfer_amount_iot",
    fmt: str = "parquet",
) -> bool:
    """Rank one day (yesterday unless given) and append it to the history.

    Returns False, having done no work, if the history holds the day already.
    """
    day = day or spark.sql("select current_date() - 1").first()[0]  # in the session's time zone, as the dates are
    history = read_history(spark, history_path)
    if history is not None and holds_date(history, day.isoformat()):
        return False
    amounts = read_table(spark, amounts_path, fmt).where(F.col("date") == F.lit(day))
    joined = located_amounts(amounts, read_table(spark, places_path, fmt), "gateway", amount, "country")
    with staged(joined, "located") as located:  # gone once the day is written
        trimmed = trim_above_quantile(located, amount, 0.999)
        append_history(share_by_group(trimmed, "country", amount).withColumn("date", F.lit(day)), history_path)
    return True


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The history table, or None before the first day."""
    try:
        return read_table(spark, path)
    except AnalysisException as err:
        if path_is_missing(err):
            return None
        raise


def latest_ranking(history: DataFrame) -> DataFrame:
    """The last day of the history in rank order."""
    last = history.agg(F.max("date")).scalar()
    return rank_order(history.where(F.col("date") == last), "country")
