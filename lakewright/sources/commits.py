"""Batches of files that readers see whole or not at all.

A batch is written to a folder of its own below ``data``. One small file below ``_commits`` shows it: its name is the number of the
commit, its content the batch's folder. Readers take the folders that commits name, so what a broken run left behind is
never read. The file appears by a rename that fails where the number is taken: of two writers that planned
on the same state one wins, and the other learns of it and plans anew. On HDFS and local disks that rename is
atomic; on an object store its check for an existing file is as strict as the store's connector makes it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from lakewright.scratch import remove
from lakewright.sources.schema_history import path_is_missing

_COMMITS = "_commits"
_DIGITS = 20
_FOLDER = "commit_folder"  # one partition column over all batches, so that they make up one table


class CommitConflict(RuntimeError):
    """Another batch was committed since the state that this one was planned on."""


def commits(spark: SparkSession, root: str) -> list[tuple[int, str, dict[str, bool] | None]]:
    """``(number, folder, parts)`` of the shown batches, in order; parts: whether the partitions that a batch replaces have rows."""
    root = root.rstrip("/")
    schema = "number long, folder string, parts map<string, boolean>"
    try:
        rows = spark.read.schema(schema).json(f"{root}/{_COMMITS}", pathGlobFilter="[0-9]" * _DIGITS).collect()
    except AnalysisException as err:
        if not path_is_missing(err):
            raise
        rows = []
    return [(r.number, f"{root}/data/{r.folder}", r.parts) for r in sorted(rows, key=lambda r: r.number)]


def version(spark: SparkSession, root: str) -> int:
    """The number of the last commit, 0 before the first."""
    return max((number for number, *_ in commits(spark, root)), default=0)


def read_batches(spark: SparkSession, root: str, schema: StructType) -> DataFrame | None:
    """The rows of all shown batches, or None if there are none. Partition columns are told from the folders' names."""
    folders = [folder for _, folder, _ in commits(spark, root)]
    if not folders:
        return None
    reader = spark.read.schema(StructType([*schema.fields, StructField(_FOLDER, StringType())]))
    return reader.option("basePath", f"{root.rstrip('/')}/data").parquet(*folders).select(*schema.fieldNames())


def append_batch(df: DataFrame, root: str, planned_on: int, partition_by: Sequence[str] = ()) -> int:
    """Write ``df``, which must not have a column ``commit_folder``, as one batch and show it as commit ``planned_on + 1``, whose number is returned.

    ``CommitConflict`` means that nothing was shown, and that the state ``df`` was planned on is out of date. A run that
    breaks off before the commit leaves an unread folder; ``sweep`` removes such folders.
    """
    spark, root, folder = df.sparkSession, root.rstrip("/"), f"{_FOLDER}={uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{root}/data/{folder}")
    try:
        _show(spark, root, planned_on + 1, folder)
    except CommitConflict:
        remove(spark, f"{root}/data/{folder}")
        raise
    return planned_on + 1


def replace_parts(df: DataFrame, root: str, planned_on: int, part_by: str, parts: Sequence[str]) -> int:
    """Write ``df`` as the new content of the partitions ``parts`` of column ``part_by``; other partitions stay as they are.

    Visible as one by commit ``planned_on + 1``, as in ``append_batch``; readers use ``read_parts``. A partition that ``df`` has no rows of
    is empty from then on. Older folders are kept for readers that still use them. Parts are named as in their folders' names.
    """
    spark, root, folder = df.sparkSession, root.rstrip("/"), f"{_FOLDER}={uuid.uuid4().hex}"
    written = set()
    if parts:
        df.write.partitionBy(part_by).parquet(f"{root}/data/{folder}")
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data/{folder}")
        files = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        written = {status.getPath().getName() for status in files.listStatus(where)}
    try:
        _show(spark, root, planned_on + 1, folder, {part: f"{part_by}={part}" in written for part in parts})
    except CommitConflict:
        remove(spark, f"{root}/data/{folder}")
        raise
    return planned_on + 1


def read_parts(spark: SparkSession, root: str, schema: StructType, part_by: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The rows of all partitions, or of ``parts``, each as the last commit that replaced it left it."""
    newest = {part: folder if rows else None for _, folder, changed in commits(spark, root) for part, rows in (changed or {}).items()}
    wanted = set(newest if parts is None else parts)
    paths = [f"{folder}/{part_by}={part}" for part, folder in sorted(newest.items()) if folder and part in wanted]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(StructType([*schema.fields, StructField(_FOLDER, StringType())]))
    return reader.option("basePath", f"{root.rstrip('/')}/data").parquet(*paths).select(*schema.fieldNames())


def _show(spark: SparkSession, root: str, number: int, folder: str, parts: dict[str, bool] | None = None) -> None:
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path
    target = path(f"{root}/{_COMMITS}/{number:0{_DIGITS}}")
    fresh = path(f"{root}/{_COMMITS}/.{folder}")
    files = target.getFileSystem(conf)
    with_content = files.create(fresh, False)
    with_content.write(json.dumps({"number": number, "folder": folder, "parts": parts}).encode())
    with_content.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(target).toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(fresh), files.makeQualified(target), options)
    except Py4JJavaError as err:
        files.delete(fresh, False)
        if "FileAlreadyExistsException" not in str(err.java_exception.getClass().getName()):
            raise
        raise CommitConflict(f"{root} has a commit {number} already") from None


def sweep(spark: SparkSession, root: str, older_than_millis: int) -> list[str]:
    """Remove the folders that no commit names and that were last changed before a time; those that went.

    Take a time before the start of any run that may still be writing.
    """
    root = root.rstrip("/")
    shown = {folder.rpartition("/")[2] for _, folder, _ in commits(spark, root)}
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data")
    files = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(where):
        return []
    found = [(s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(where)]
    stale = sorted(name for name, changed in found if name not in shown and changed < older_than_millis)
    for name in stale:
        remove(spark, f"{root}/data/{name}")
    return stale
