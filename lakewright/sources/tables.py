"""Reading, registering and writing tables by path and format."""

from __future__ import annotations

import os
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakewright.sources.schema_history import latest_schema


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    streaming: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """A batch or streaming DataFrame over the table at ``path``.

    Without ``schema``, the schema recorded beside the table is used if there is
    one, so files older than the last added column read as null there without a
    merge over all footers. A parquet stream falls back to the files' own schema.
    """
    if fmt == "parquet":
        schema = schema or latest_schema(spark, path)
        if streaming and schema is None:
            schema = spark.read.parquet(path).schema
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if streaming and _is_file(spark, path):
        # a file stream watches a folder: here its folder, for this one name
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).load(folder)
    return reader.load(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).isFile(where)


def register_tables(
    spark: SparkSession,
    paths: Mapping[str, str],
    fmt: str = "parquet",
    streaming: bool | Collection[str] = False,
) -> list[str]:
    """Register each ``name: path`` as a temporary view under the lower-cased name.

    ``streaming`` holds for all tables or names those that stream; the others are fixed tables that each micro-batch reads as they
    were when the job started, Delta tables as they are by then.
    """
    streams = {n.lower() for n in (paths if streaming is True else streaming or ())}
    unknown = streams - {n.lower() for n in paths}
    if unknown:
        raise ValueError(f"no such tables: {sorted(unknown)}")
    for name, path in paths.items():
        read_table(spark, path, fmt, name.lower() in streams).createOrReplaceTempView(name.lower())
    return [name.lower() for name in paths]


def tables_from_env(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """``TABLE_X=path`` variables as ``{"x": path}``."""
    env = os.environ if env is None else env
    return {k[len("TABLE_") :].lower(): v for k, v in env.items() if k.startswith("TABLE_")}


def overwrite_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace the whole table at ``path`` by ``df``."""
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
