"""Running one SQL file over named tables, as a batch overwrite or a streaming append."""

from __future__ import annotations

import os
from collections.abc import Collection, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakewright.functions import register_functions
from lakewright.session import build_session
from lakewright.sources.tables import overwrite_table, register_tables, tables_from_env
from lakewright.streaming.triggers import trigger_options


def run_sql_batch(
    spark: SparkSession, sql: str, output: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace the table at ``output`` by the query's result."""
    overwrite_table(spark.sql(sql), output, fmt, partition_by)


def run_sql_stream(
    spark: SparkSession,
    sql: str,
    output: str,
    checkpoint: str,
    partition_by: Sequence[str],
    fmt: str = "parquet",
    trigger: str = "ProcessingTime",
    interval: str | None = None,
) -> StreamingQuery:
    """Start appending the query's result to the table at ``output``.

    Progress lives in the checkpoint; a restart goes on where it stopped. The query
    must be stateless or aggregate over a watermark, as rows are only ever appended.
    """
    options = trigger_options(trigger, interval)
    df: DataFrame = spark.sql(sql)
    if not df.isStreaming:
        raise ValueError("the query reads no streaming table; run it as a batch")
    try:
        return (
            df.writeStream.format(fmt)
            .outputMode("append")
            .partitionBy(*partition_by)
            .option("checkpointLocation", checkpoint)
            .trigger(**options)
            .start(output)
        )
    except AnalysisException as err:
        if "streaming aggregation" in str(err):
            raise ValueError(
                "a query that groups all rows cannot append to a stream; run it as a batch"
            ) from err
        raise


def run_sql_job(
    spark: SparkSession,
    sql: str,
    tables: Mapping[str, str],
    output: str,
    streaming: bool | Collection[str] = False,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    checkpoint: str | None = None,
    trigger: str = "ProcessingTime",
    interval: str | None = None,
) -> StreamingQuery | None:
    """Register functions and tables, then run the SQL; a stream is returned running.

    ``streaming`` may name the tables that stream; the query can then join them with the others, which stay fixed tables.
    """
    register_functions(spark)
    register_tables(spark, tables, fmt, streaming)
    if not streaming:
        run_sql_batch(spark, sql, output, fmt, partition_by)
        return None
    if not checkpoint:
        raise ValueError("a streaming job needs a checkpoint folder")
    return run_sql_stream(spark, sql, output, checkpoint, partition_by, fmt, trigger, interval)


def run_from_env(env: Mapping[str, str] | None = None, fmt: str = "delta") -> None:
    """The job described by environment variables, until it ends.

    ``QUERY_PATH``, ``OUTPUT``, ``TABLE_<NAME>``, ``SPARK_<KEY>``; ``BATCH_PROCESSING``
    (default false); for streams ``PARTITION_BY`` (comma-separated), ``BATCH_TABLES`` (comma-separated names of tables that
    do not stream), ``CHECKPOINT``, ``TRIGGER`` and ``TRIGGER_INTERVAL``. The command line takes the tables' format from ``OUTPUT_FORMAT`` (default delta).
    """
    env = os.environ if env is None else env
    streaming = env.get("BATCH_PROCESSING", "false").lower() != "true"
    spark = build_session("sql-job", env=env, delta=fmt == "delta")
    with open(env["QUERY_PATH"], encoding="utf-8") as f:
        sql = f.read()
    tables = tables_from_env(env)
    fixed = {name.strip().lower() for name in env.get("BATCH_TABLES", "").split(",")}
    query = run_sql_job(
        spark,
        sql,
        tables,
        env["OUTPUT"],
        [name for name in tables if name not in fixed] if streaming else False,
        fmt,
        [c for c in env.get("PARTITION_BY", "").split(",") if c and streaming],
        env.get("CHECKPOINT"),
        env.get("TRIGGER", "ProcessingTime"),
        env.get("TRIGGER_INTERVAL"),
    )
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    run_from_env(fmt=os.environ.get("OUTPUT_FORMAT", "delta"))
