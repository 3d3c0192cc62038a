"""Row keys, row numbers and small helpers that the text operators share."""

from __future__ import annotations

import ctypes
import functools
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakewright.scratch import stage


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until no column of ``df`` is called so, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(df: DataFrame, id_col: str, text_col: str, whole: bool = False) -> DataFrame:
    """``rid, id, text``: a unique long per row that sorts as the ids do, the id, and the text with null as empty.

    A whole-number id that is unique and never null is its own key. Otherwise (repeated or null
    ids, other types) the rows are sorted by id, nulls first and equal ids in a fixed but arbitrary
    order, numbered increasingly and written once, so that the keys stay the same in every later pass.
    Only these columns are taken along, so whatever else the table holds cannot clash; ``whole`` adds the
    input row as the struct ``row``.
    """
    columns = [F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    rows = df.select(*columns, F.struct("*").alias("row")) if whole else df.select(*columns)
    if isinstance(rows.schema["id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        n, ids, distinct = rows.agg(F.count("*"), F.count("id"), F.count_distinct("id")).first()
        if n == ids == distinct:
            return rows.select(F.col("id").cast("long").alias("rid"), "*")
    ordered = rows.orderBy("id", F.xxhash64("text"))
    return stage(ordered.select(F.monotonically_increasing_id().alias("rid"), "*"), "keyed")


BROADCAST_ROWS = 1 << 20  # of two long columns, about 40 MB in each executor


def broadcast_if_small(keys: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``keys``, a written table of two long columns at most, marked for broadcast if it has no more than ``most`` rows.

    Beyond that it stays as it is, and the join it takes part in shuffles both sides.
    """
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys


def number_rows(df: DataFrame, *order: Any) -> tuple[DataFrame, int]:
    """``df`` with ``row_no``, counting from 0 without gaps in the given order, and the number of rows.

    One distributed sort; each partition numbers its own rows and is then moved by the rows before
    it. Only one row per partition is brought together for that. Ties get an arbitrary order that
    the written copy fixes. Meant for narrow rows; they are written first, as a sort reads its input twice,
    the first time to find the bounds of its partitions.
    """
    sorted_rows = stage(df, "unsorted").orderBy(*order).withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    )
    rows = stage(sorted_rows, "numbered")
    parts = rows.groupBy("_part").agg((F.max("_at") + 1).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("_part", "_n", before.alias("_before"))
    n = parts.agg(F.sum("_n")).first()[0] or 0
    # one row per partition of the sort
    placed = rows.join(F.broadcast(starts.drop("_n")), "_part")
    return placed.withColumn("row_no", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before"), n


_WORKER, _KEPT = "_lakewright_worker", 2  # where a worker keeps things, and how many


def in_worker(name: str, build: Callable[[], Any]) -> Any:
    """What ``build`` returns, built once per Python worker process and kept between its tasks until two others are asked for."""
    held = sys.modules.setdefault(_WORKER, types.ModuleType(_WORKER)).__dict__.setdefault("kept", {})
    value = held.pop(name) if name in held else None
    if value is None:
        while len(held) >= _KEPT:
            del held[next(iter(held))]
        value = build()
    held[name] = value
    return value


def forget_in_worker() -> None:
    """Drop what other operators keep in this worker, for one that has its own use of the memory."""
    sys.modules.pop(_WORKER, None)


def release_memory() -> None:
    """Hand back to the system what this process has freed. Workers live on between tasks, and libraries keep freed memory for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function over the batches of a task, after which the worker hands back what the task has freed."""

    @functools.wraps(run)
    def leaner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:  # what ``run`` held is gone by now
            release_memory()

    return leaner


PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose values of ``column``, binary and never null, have ``most`` bytes together, or of one longer row.

    Spark fills a batch by the number of its rows, so what a task makes of a whole batch grows with the length of the texts.
    """
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


class Memo:
    """A cache of bounded size: what was not asked for during a whole generation is forgotten."""

    def __init__(self, size: int) -> None:
        self.size, self.young, self.old = size, {}, {}

    def recall(self, key):
        """The value from the older generation, made young again, or None."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
