"""Reading what an ingest has not read yet, as one batch."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.operators.resume import pending_objects
from lakewright.scratch import qualified_path, stage
from lakewright.sources.listing import list_objects
from lakewright.sources.messages import MessageFormat, decode_objects
from lakewright.sources.mirrors import KEY, object_key, one_of_each
from lakewright.sources.stores import store_settings, tasks_can_open


def pending_objects_of(
    spark: SparkSession,
    source: str,
    ledger: DataFrame,
    *,
    prefix: str = "",
    after: int | None = None,
    before: int | None = None,
    exclude: DataFrame | None = None,
    look_back_millis: int | None = None,
    task_bytes: int = 128 * 1024 * 1024,
    tasks: int | None = None,
    mirrors: Sequence[str] = (),
) -> DataFrame:
    """``path, length, file_ts`` of the objects under ``source`` that the ledger does not hold, spread over tasks.

    Lists without reading and leaves out what the ledger (``path, file_ts``) or ``exclude`` (``path``) holds. No object is too old,
    unless ``after`` or a look-back behind the newest object read says so. What is pending is written once.
    With ``mirrors``, folders that hold some of the same objects under the same keys, objects are told apart by key: name all
    folders that the ledger was read from, also one that is empty by now.
    Objects are dealt by path to a task for each ``task_bytes`` of them, or to ``tasks``, and to one per core at least.
    In a store that tasks cannot open themselves, there is a ``content`` column too, and Spark plans the tasks.
    """
    roots = [source, *mirrors]
    listing = reduce(DataFrame.unionByName, [list_objects(spark, root, prefix, after, before) for root in roots])
    key = "path"
    if mirrors:
        key, full = KEY, [qualified_path(spark, root) for root in roots]
        listing = one_of_each(listing, full)
        ledger = ledger.withColumn(KEY, object_key(F.col("path"), full))
        exclude = None if exclude is None else exclude.select(object_key(F.col("path"), full).alias(KEY))
    found = pending_objects(listing, ledger, look_back_millis, exclude, key)
    pending = stage(found.select("path", "length", "file_ts"), "pending")
    if not all(tasks_can_open(qualified_path(spark, root), store_settings(spark)) for root in roots):
        return _with_contents(spark, source, pending)
    if tasks is None:
        size = pending.agg(F.sum("length")).first()[0] or 0
        tasks = max(spark.sparkContext.defaultParallelism, math.ceil(size / task_bytes))
    # a fixed number: by their few bytes, adaptive execution would merge all paths into one task
    return pending.repartition(tasks, "path")


def _with_contents(spark: SparkSession, source: str, pending: DataFrame) -> DataFrame:
    """The objects with their contents, read by Spark. Its planner holds the paths of a read on the driver in any case."""
    paths = [r.path for r in pending.select("path").toLocalIterator()]
    reader = spark.read.format("binaryFile")
    found = reader.load(paths) if paths else reader.load(source).where(F.lit(False))
    # the name of an object holds its time, so nothing is joined back
    return found.select("path", "length", "content")


def pending_rows(spark: SparkSession, source: str, ledger: DataFrame, fmt: MessageFormat, **options) -> DataFrame:
    """Decoded rows, with an ``error`` column like ``decode_objects``, of what ``pending_objects_of`` gives."""
    return decode_objects(pending_objects_of(spark, source, ledger, **options), fmt)
