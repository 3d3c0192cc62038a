"""Source objects named ``prefix.millis.gz``: listing, name parsing, time window."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

# Fixed value: <prefix>.<epoch millis>, optionally followed by .gz, as the whole base name.
NAME_PATTERN = r"^([^.]+)\.([0-9]+)(?:\.gz)?$"

OBJECT_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)

_DIGITS = 13  # epoch millis from September 2001 to 2286
_RESOLUTION = 8  # listing is pruned to about a day; rows are then filtered exactly


#: Left to itself, Spark forgets and skips what is seven days older than the newest object.
NO_AGE_LIMIT = "36500d"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def name_prefix(path: Column) -> Column:
    return F.regexp_extract(base_name(path), NAME_PATTERN, 1)


def name_millis(path: Column) -> Column:
    """Epoch millis in an object name; null where the name does not follow the pattern."""
    return F.regexp_extract(base_name(path), NAME_PATTERN, 2).try_cast("bigint")


def strip_root(path: Column | str, root: str) -> Column:
    """Object key below ``root``; a path outside it is left as it is."""
    col = F.col(path) if isinstance(path, str) else path
    full = root.rstrip("/") + "/"
    return F.when(F.startswith(col, F.lit(full)), F.substring(col, len(full) + 1, 2**31 - 1)).otherwise(col)


def object_uri(key: Column | str, root: str) -> Column:
    """Full URI of an object key."""
    return F.concat(F.lit(root.rstrip("/") + "/"), F.col(key) if isinstance(key, str) else key)


def millis_glob(prefix: str, after: int | None, before: int | None) -> str:
    """A name glob that admits every object in the window and little else.

    Spark still lists the folder, but plans, sorts and remembers only the objects whose
    names match: with a start of one day ago, one day of them and not years. A superset
    is enough, because ``in_window`` then decides exactly.
    """
    low, high = after or 0, 10**_DIGITS - 1 if before is None else before
    if low < 10 ** (_DIGITS - 1) or any(c in prefix for c in "*?[]{}\\"):
        return "*" if any(c in prefix for c in "*?[]{}\\") else f"{prefix}*"
    starts: list[str] = []

    def cover(start: str) -> None:
        width = 10 ** (_DIGITS - len(start))
        first = int(start or 0) * width
        last = first + width - 1
        if last < low or first > high:
            return
        if (first >= low and last <= high) or len(start) == _DIGITS - _RESOLUTION:
            starts.append(start)
            return
        for digit in range(10):
            cover(start + str(digit))

    for digit in range(1, 10):
        cover(str(digit))
    names = [s + "*" for s in starts]
    if before is None or before >= 10**_DIGITS:
        names.append("[0-9]" * (_DIGITS + 1) + "*")  # longer numbers are later ones
    return f"{prefix}*.{{{','.join(names)}}}"


def in_window(millis: Column, after: int | None, before: int | None) -> Column:
    """Half-open on the left: after < millis <= before; null is never inside."""
    if after is None and before is None:
        return millis.isNotNull()
    # each bound rejects null by itself, so the name is not parsed a further time
    keep = F.lit(True)
    if after is not None:
        keep &= millis > after
    if before is not None:
        keep &= millis <= before
    return keep


def select_objects(
    listing: DataFrame,
    prefix: str = "",
    after: int | None = None,
    before: int | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Objects of a ``path`` listing that match prefix, window and exclusion.

    Adds ``file_ts``. Names that do not follow the pattern are skipped. ``exclude``
    takes base names or full paths and is meant for a handful; a ledger of
    everything already read is a DataFrame for ``resume.pending_objects``.
    """
    base = base_name(F.col("path"))
    out = listing.where(F.startswith(base, F.lit(prefix))) if prefix else listing
    out = out.withColumn("file_ts", name_millis(F.col("path"))).where(
        in_window(F.col("file_ts"), after, before)
    )
    exclude = list(exclude)
    if exclude:
        out = out.where(~base.isin(exclude) & ~F.col("path").isin(exclude))
    return out


def _objects(reader, root: str, prefix: str, after: int | None, before: int | None, exclude: Iterable[str]) -> DataFrame:
    objects = (
        reader.option("pathGlobFilter", millis_glob(prefix, after, before))
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "content")
    )
    return select_objects(objects, prefix, after, before, exclude)


def read_objects(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    after: int | None = None,
    before: int | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """``path, length, content, file_ts`` of the objects under ``root``.

    Spark reads contents only if the plan uses that column, and holds each whole in
    memory: 2 GB is its limit. Reading stages given only ``path`` open objects themselves.
    """
    return _objects(spark.read.format("binaryFile"), root, prefix, after, before, exclude)


def list_objects(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    after: int | None = None,
    before: int | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """``path, length, file_ts`` of the objects under ``root``; contents are not read."""
    return read_objects(spark, root, prefix, after, before, exclude).drop("content")


def stream_objects(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    after: int | None = None,
    before: int | None = None,
    exclude: Iterable[str] = (),
    max_bytes_per_trigger: int | None = 500_000_000,
    max_file_age: str = NO_AGE_LIMIT,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same as an unbounded stream: each trigger takes up to so many bytes of new objects.

    An object larger than the limit forms a micro-batch alone. Objects are told
    apart by path, so one with an older name or modification time that turns up late is still read:
    nothing is too old unless ``max_file_age`` says so. The driver remembers the paths of all objects read, some
    hundred bytes each and so a few hundred megabytes per million; an age limit or ``cleanSource`` bounds that.
    ``options`` go to Spark's file source, for example ``cleanSource`` with
    ``sourceArchiveDir``, which moves objects away once they are read and so keeps
    the folder that every trigger lists small.
    """
    reader = spark.readStream.format("binaryFile").schema(OBJECT_SCHEMA)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    reader = reader.option("maxFileAge", max_file_age).options(**(options or {}))
    return _objects(reader, root, prefix, after, before, exclude)
