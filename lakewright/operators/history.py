"""Daily results appended to a history, each date at most once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.sources.schema_history import path_is_missing, record_schema


def extend_history(history: DataFrame, new: DataFrame, date: str = "date") -> DataFrame:
    """``history`` plus the rows of ``new`` whose date it does not hold yet, matched by name."""
    known = history.select(date).distinct()
    return history.unionByName(new.join(known, date, "left_anti"))


def append_history(new: DataFrame, path: str, date: str = "date") -> None:
    """Append the dates of ``new`` that the parquet table at ``path`` does not hold.

    The table is partitioned by date, so the check reads no data columns and earlier
    dates are not rewritten. With dynamic partition overwrite a date's folder is
    staged and appears when the job commits.
    """
    spark = new.sparkSession
    schema = record_schema(spark, path, new.schema)
    try:
        known = spark.read.schema(schema).parquet(path).select(date).distinct()
        new = new.join(known, date, "left_anti")
    except AnalysisException as err:
        if not path_is_missing(err):
            raise
    (
        new.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date)
        .parquet(path)
    )


def replace_dates(new: DataFrame, path: str, date: str = "date") -> None:
    """Rewrite exactly the dates of ``new``; every other date stays as it is."""
    record_schema(new.sparkSession, path, new.schema)
    (
        new.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date)
        .parquet(path)
    )


def holds_date(history: DataFrame, day: str, date: str = "date") -> bool:
    """Whether the history has any row of that day; reads one partition at most."""
    return not history.where(F.col(date) == F.lit(day).cast("date")).select(date).isEmpty()
