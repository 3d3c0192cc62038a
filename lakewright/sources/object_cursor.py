"""A streaming source of object listings whose memory is one look-back of names.

Spark's own file source remembers the path of every object it ever read. Here the offset of a stream is the newest time in an
object's name and the names that lie within the look-back behind it; a micro-batch is what the next listing holds
beyond that: newer objects, and such that turned up late within the look-back. What turns up later still is not seen by the
stream; it is what ``plans.backfill`` finds by joining the listing with the table's ledger.

An offset follows from the listing alone, so a restarted stream needs nothing but its checkpoint. A batch that is planned again
after a failure may also hold an older object that came in meanwhile; as the batch was not committed, it is read once all the same.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from lakewright.functions.epoch import MILLIS_PER_DAY
from lakewright.scratch import qualified_path
from lakewright.sources.listing import NAME_PATTERN
from lakewright.sources.stores import store_of, store_settings

FORMAT = "object_cursor"
TASK_BYTES = 128 * 1024 * 1024

Found = tuple[str, int, int]  # name below the root, length, millis


class Chunk(InputPartition):
    """The objects that one task reports."""

    def __init__(self, rows: list[tuple[str, int, int]]) -> None:
        self.rows = rows


def deal(found: list[Found], task_bytes: int, least: int) -> list[list[Found]]:
    """The objects in order, cut so that a part holds ``task_bytes`` at most or one object, in ``least`` parts or more if there are as many."""
    target = min(task_bytes, max(1, sum(f[1] for f in found) // least))
    parts: list[list[Found]] = []
    size = 0
    for f in found:
        if not parts or size + f[1] > target:
            parts.append([])
            size = 0
        parts[-1].append(f)
        size += f[1]
    return parts


class CursorReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"].rstrip("/")
        self.settings = json.loads(options["settings"])
        self.prefix = options.get("prefix", "")
        self.after = int(options["after"]) if "after" in options else None
        self.before = int(options["before"]) if "before" in options else None
        self.look_back = int(options["lookback"])
        self.task_bytes, self.tasks = int(options["taskbytes"]), int(options["tasks"])
        self.listed: tuple[str, list[Found]] | None = None  # the last offset given, and what was listed for it

    def _list(self, above: int | None = None) -> list[Found]:
        """The objects of the window whose millis lie above a bound, by millis and name."""
        store, base = store_of(self.root, self.settings)
        found = []
        for info in store.get_file_info(pafs.FileSelector(base, allow_not_found=True, recursive=True)):
            named = re.match(NAME_PATTERN, info.base_name) if info.type == pafs.FileType.File else None
            if named is None or not info.base_name.startswith(self.prefix):
                continue
            millis = int(named[2])
            if all(low is None or millis > low for low in (self.after, above)) and (self.before is None or millis <= self.before):
                found.append((info.path.removeprefix(base).lstrip("/"), info.size, millis))
        return sorted(found, key=lambda f: (f[2], f[0]))

    def initialOffset(self) -> dict:
        return {"newest": None, "recent": []}

    def latestOffset(self) -> dict:
        found = self._list()
        offset = self.initialOffset()
        if found:
            newest = found[-1][2]
            offset = {"newest": newest, "recent": sorted(f[0] for f in found if f[2] > newest - self.look_back)}
        self.listed = (json.dumps(offset, sort_keys=True), found)
        return offset

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if start == end or end["newest"] is None:
            return []
        floor = None if start["newest"] is None else start["newest"] - self.look_back
        found = None
        if self.listed is not None and self.listed[0] == json.dumps(end, sort_keys=True):
            found = self.listed[1]
        if found is None:  # a batch of an earlier run
            found = self._list(floor)
        self.listed = None
        seen, recent, border = set(start["recent"]), set(end["recent"]), end["newest"] - self.look_back
        new = [
            f for f in found
            if (floor is None or f[2] > floor) and f[0] not in seen and (f[0] in recent if f[2] > border else True)
        ]
        return [Chunk([(f"{self.root}/{name}", n, t) for name, n, t in part]) for part in deal(new, self.task_bytes, self.tasks)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from partition.rows


class CursorSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, length bigint, file_ts bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return CursorReader({k.lower(): v for k, v in self.options.items()})


def stream_listing(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    after: int | None = None,
    before: int | None = None,
    look_back_millis: int = MILLIS_PER_DAY,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """``path, length, file_ts`` of the objects under ``root`` as an unbounded stream; contents are not read.

    A trigger takes all there is, dealt out in parts of about ``task_bytes`` of objects; where that is too much for a first
    run, let ``before`` bound it or load the history as a batch. Names that do not follow the pattern are
    skipped. The offset in the checkpoint grows with the objects of one look-back and with nothing else. Root, prefix, window and look-back
    belong to a checkpoint; with a longer look-back, older names would be read again.
    """
    spark.dataSource.register(CursorSource)
    options = {
        "prefix": prefix, "lookBack": look_back_millis, "taskBytes": task_bytes, "tasks": spark.sparkContext.defaultParallelism,
        "settings": json.dumps(store_settings(spark)), **{k: v for k, v in (("after", after), ("before", before)) if v is not None},
    }
    reader = spark.readStream.format(FORMAT).options(**{k: str(v) for k, v in options.items()})
    return reader.load(qualified_path(spark, root))
