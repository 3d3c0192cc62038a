"""The gold table of active entities, kept up by a stream instead of computed anew.

Each micro-batch is reduced to the latest time per day and entity and merged into the months it touches; only these are
rewritten, and all of them become visible by one commit. The commit's number is that of the micro-batch, so a batch that is run again
after a failure finds its commit and does nothing. Which entities are active as of a day is then read from
the months of the window alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from lakewright.plans.rewards import ACTIVE_DAYS, any_positive
from lakewright.scratch import remove, scratch_dir
from lakewright.sources import commits
from lakewright.streaming.triggers import trigger_options

_PART = "month"
_LATEST = StructType(
    [
        StructField("date", DateType()),
        StructField("entity_key", StringType()),
        StructField("most_recent_ts", LongType()),
        StructField(_PART, StringType()),
    ]
)


def _month(day: Column) -> Column:
    """A partition's name; the letter keeps it a text."""
    return F.date_format(day, "'m'yyyy-MM")


def merge_latest(batch: DataFrame, batch_id: int, target: str, amounts: Sequence[str]) -> None:
    """Merge the rows ``date, entity_key, end_period`` and amounts of a micro-batch into the months they touch.

    Rows without a date or without a positive amount count for nothing.
    """
    spark = batch.sparkSession
    done = commits.version(spark, target)
    if done > batch_id:
        return
    latest = batch.where(any_positive(amounts) & F.col("date").isNotNull()).groupBy("date", "entity_key")
    path = scratch_dir(spark, "latest")
    try:
        latest.agg(F.max("end_period").alias("most_recent_ts")).withColumn(_PART, _month(F.col("date"))).write.parquet(path)
        new = spark.read.schema(_LATEST).parquet(path)
        months = [r[0] for r in new.select(_PART).distinct().collect()]
        both = new.unionByName(commits.read_parts(spark, target, _LATEST, _PART, months))
        merged = both.groupBy(_PART, "date", "entity_key").agg(F.max("most_recent_ts").alias("most_recent_ts"))
        # a file or a few per month: adaptive execution splits what is large
        commits.replace_parts(merged.hint("rebalance", _PART), target, batch_id, _PART, months)
    finally:
        remove(spark, path)


def maintain_latest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    amounts: Sequence[str],
    trigger: str = "AvailableNow",
    interval: str | None = None,
) -> StreamingQuery:
    """Start merging a stream of silver rows into the table at ``target``. Table and checkpoint belong to each other."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_latest(batch, batch_id, target, amounts)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_options(trigger, interval)).start()


def read_active(
    spark: SparkSession, target: str, network: str, as_of: dt.date | None = None, days: int = ACTIVE_DAYS
) -> DataFrame:
    """``most_recent_ts, entity_key, sub_dao`` as ``rewards.active_in_network`` computes them, from the table kept up."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    first = F.date_sub(day, days)
    latest = commits.read_parts(spark, target, _LATEST, _PART)
    recent = latest.where((F.col(_PART) >= _month(first)) & (F.col("date") >= first))
    return recent.groupBy("entity_key").agg(F.max("most_recent_ts").alias("most_recent_ts")).select(
        "most_recent_ts", "entity_key", F.lit(network).alias("sub_dao")
    )
