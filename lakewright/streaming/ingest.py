"""Bronze ingest: framed protobuf objects into a date-partitioned table, incrementally or as a batch."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from lakewright.plans.backfill import pending_objects_of
from lakewright.scratch import qualified_path
from lakewright.sources import commits
from lakewright.sources.listing import NO_AGE_LIMIT, name_millis, select_objects, stream_objects
from lakewright.sources.messages import ABOUT, ABOUT_SCHEMA, KIND, OBJECT, RECORD, REJECT, MessageFormat, decode_all
from lakewright.sources.mirrors import DELAY, KEY, first_of_each, object_key
from lakewright.sources.object_cursor import stream_listing
from lakewright.sources.schema_history import latest_schema, path_is_missing, record_schema
from lakewright.sources.stores import store_settings, tasks_can_open
from lakewright.streaming.triggers import trigger_options

BYTES_PER_CORE = 128 * 1024 * 1024  # of objects in a micro-batch, unless told otherwise


def ingest_objects(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    fmt: MessageFormat,
    *,
    prefix: str = "",
    after: int | None = None,
    before: int | None = None,
    exclude: Iterable[str] = (),
    already_read: DataFrame | None = None,
    max_bytes_per_trigger: int | None = None,
    max_file_age: str = NO_AGE_LIMIT,
    trigger: str = "AvailableNow",
    interval: str | None = None,
    table_format: str = "parquet",
    open_in_tasks: bool = False,
    spread_above: int | None = None,
    source_options: Mapping[str, str] | None = None,
    look_back_millis: int | None = None,
    mirrors: Sequence[str] = (),
    mirror_delay: str = DELAY,
) -> StreamingQuery:
    """Start appending the objects under ``source`` to the table at ``target``.

    The checkpoint remembers which objects were read, by path: a restart adds
    nothing twice, and an object with an older name that appears later is still
    taken. The file sink commits each micro-batch whole. ``AvailableNow`` takes
    what is there in batches of about ``max_bytes_per_trigger`` (128 MB for each core unless given) and stops.

    One reading of the objects gives records, rejects and a row for each finished object. They go through one
    sink into one table, whose first partition column is their kind, so that all three are complete or absent
    together; ``read_bronze``, ``read_rejects`` and ``read_ledger`` each read their own partitions.

    Spark hands contents to the tasks, up to 2 GB each. With ``open_in_tasks`` it
    only lists, and each task streams its objects through Arrow's file systems:
    for larger objects, and where memory is short. In a store that tasks cannot open, Spark hands over the contents all the same.

    With ``look_back_millis``, objects are found by ``object_cursor.stream_listing``, which remembers one look-back of names and not all
    paths ever read, and tasks open them. It takes all there is at each trigger. An object that turns up later than that is
    left to ``ingest_pending``, which finds it by the ledger.

    One task reads one object. Where single objects are large, those above
    ``spread_above`` bytes are only split into records by that task, and the
    records are parsed by all.

    ``mirrors`` are folders that hold some of the same objects under the same keys; each object is taken from one of them. The stream
    remembers the keys of ``mirror_delay``, by the times in their names, and leaves what is older than that behind the newest object of the batches before
    to ``ingest_pending`` with the same mirrors. Tasks must be able to open the objects, as keys are shuffled.

    ``already_read`` (a ``path`` column) leaves out objects another job loaded. A
    ledger too large to broadcast makes that a shuffle of the source rows: use it with
    ``open_in_tasks``, so that paths are shuffled and not contents.
    ``source_options`` are passed on to the file source.
    """
    roots = [source, *mirrors]
    opens = all(tasks_can_open(qualified_path(spark, root), store_settings(spark)) for root in roots)
    if (mirrors or look_back_millis is not None) and not opens:
        raise ValueError(f"tasks cannot open the objects of {', '.join(roots)}; leave out the mirrors and the look-back")
    if max_bytes_per_trigger is None and "maxFilesPerTrigger" not in (source_options or {}):
        max_bytes_per_trigger = BYTES_PER_CORE * spark.sparkContext.defaultParallelism
    schema = fmt.schema() if table_format != "parquet" else record_schema(spark, target, fmt.schema())

    def rows_of(root: str) -> DataFrame:
        if look_back_millis is not None:
            return select_objects(stream_listing(spark, root, prefix, after, before, look_back_millis), exclude=exclude)
        found = stream_objects(spark, root, prefix, after, before, exclude, max_bytes_per_trigger, max_file_age, source_options)
        return found.drop("content") if mirrors or (open_in_tasks and opens) else found

    source_rows = reduce(DataFrame.unionByName, [rows_of(root) for root in roots])
    if mirrors:
        roots = [qualified_path(spark, root) for root in roots]
        if already_read is not None:
            seen = already_read.select(object_key(F.col("path"), roots).alias(KEY))
            source_rows = source_rows.withColumn(KEY, object_key(F.col("path"), roots)).join(seen, KEY, "left_anti").drop(KEY)
        source_rows = first_of_each(source_rows, roots, mirror_delay)
    elif already_read is not None:
        source_rows = source_rows.join(already_read.select("path"), "path", "left_anti")
    rows = decode_all(source_rows, fmt, spread_above, spark.sparkContext.defaultParallelism)
    writer = rows.select(*schema.fieldNames(), ABOUT, KIND).writeStream.format(table_format).outputMode("append")
    writer = writer.partitionBy(*_partitions(fmt))
    return (
        writer.option("checkpointLocation", checkpoint)
        .option("mergeSchema", "true")  # read by table formats that evolve in their own log
        .trigger(**trigger_options(trigger, interval))
        .start(target)
    )


def ingest_pending(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: MessageFormat,
    *,
    table_format: str = "parquet",
    attempts: int = 5,
    **options,
) -> None:
    """Append, as one batch, the objects under ``source`` that the table does not hold yet.

    What is pending is told by the table's own ledger, however old it is; ``options`` are those of ``pending_objects_of``. Records,
    rejects and object rows become visible together by one commit, so a run that breaks off shows nothing and one that is
    repeated adds nothing. If another batch was committed meanwhile, what is pending is found and read anew, up to
    ``attempts`` times. A plain append beside a streaming file sink would not be seen by its readers: a batch goes to a sibling folder,
    which the readers here take in. A stream started later on the same source does not know these objects; give it
    ``already_read=read_ledger(...)``. Other table formats commit by themselves; there, one such batch may run at a time.
    """
    schema = fmt.schema() if table_format != "parquet" else record_schema(spark, target, fmt.schema())
    for attempt in range(1, attempts + 1):
        planned_on = commits.version(spark, _batches(target)) if table_format == "parquet" else 0
        pending = pending_objects_of(spark, source, read_ledger(spark, target, table_format), **options)
        if pending.isEmpty():
            return
        rows = decode_all(pending, fmt).select(*schema.fieldNames(), ABOUT, KIND)
        if table_format != "parquet":
            rows.write.format(table_format).mode("append").partitionBy(*_partitions(fmt)).save(target)
            return
        try:
            commits.append_batch(rows, _batches(target), planned_on, _partitions(fmt))
            return
        except commits.CommitConflict:
            if attempt == attempts:
                raise


def _partitions(fmt: MessageFormat) -> list[str]:
    return [KIND] if fmt.date_field is None else [KIND, "date"]


def _batches(target: str) -> str:
    return f"{target.rstrip('/')}-batches"


def _rows(spark: SparkSession, target: str, kind: str, table_format: str) -> DataFrame:
    """The rows of one kind of the stream's table and of the batches beside it; only their partitions are read."""
    if table_format != "parquet":
        return spark.read.format(table_format).load(target).where(F.col(KIND) == kind)
    recorded = latest_schema(spark, target)
    parts = [StructField(ABOUT, ABOUT_SCHEMA), StructField(KIND, StringType())]
    schema = StructType((recorded.fields if recorded is not None else [StructField("file", StringType())]) + parts)
    found = [commits.read_batches(spark, _batches(target), schema)]
    try:
        found.append(spark.read.schema(schema).parquet(target))
    except AnalysisException as err:
        if not path_is_missing(err):
            raise
    found = [rows.select(*schema.fieldNames()) for rows in found if rows is not None]
    rows = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
    return rows.where(F.col(KIND) == kind)


def read_bronze(spark: SparkSession, target: str, table_format: str = "parquet") -> DataFrame:
    """The ingested records under their evolved schema, empty before the first batch."""
    return _rows(spark, target, RECORD, table_format).drop(ABOUT, KIND)


def read_rejects(spark: SparkSession, target: str, table_format: str = "parquet") -> DataFrame:
    """``file, offset, error, record`` of what was read and could not be taken."""
    rows = _rows(spark, target, REJECT, table_format)
    return rows.select("file", *(F.col(ABOUT)[c].alias(c) for c in ("offset", "error", "record")))


def read_ledger(spark: SparkSession, target: str, table_format: str = "parquet") -> DataFrame:
    """``path, file_ts, frames`` of every object that was read, also of those that gave no record."""
    rows = _rows(spark, target, OBJECT, table_format)
    return rows.select(F.col("file").alias("path"), name_millis(F.col("file")).alias("file_ts"), F.col(ABOUT)["frames"].alias("frames"))


def ingest_counts(spark: SparkSession, target: str, table_format: str = "parquet") -> dict[str, int]:
    """Accepted and rejected records of the whole table, from its ledger and its rejects."""
    frames = read_ledger(spark, target, table_format).agg(F.sum("frames")).first()[0] or 0
    rejected = read_rejects(spark, target, table_format).count()
    return {"accepted": frames - rejected, "rejected": rejected}
