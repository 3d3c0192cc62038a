"""Working folders that every executor can reach."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share.

    That is ``spark.checkpoint.dir``, else the folder given to ``SparkContext.setCheckpointDir``,
    else one below the warehouse, where tables are shared anyway.
    """
    root = spark.conf.get(_KEY, None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared one. It lasts until ``remove`` or its owner deletes it."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def qualified_path(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark would read it under, for readers outside Hadoop."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through its own file system; nothing happens if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage for input that several passes read: the files outlive lost
    executors, and each pass reads only the columns it needs.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stage`` whose folder goes at the end of the block; results must be written inside it."""
    path = scratch_dir(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)
