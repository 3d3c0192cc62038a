"""Grouping ordered items into batches of bounded size.

Items are taken in order; a batch is closed when the next item would take it over the
limit, and an item above the limit stands alone. Where a batch starts depends on all
items before it, yet no task sees a whole group: items are sorted and cut into chunks of a fixed number of rows, each chunk
is summed up on its own as "entered with a batch already holding t bytes, it is left with
a batch holding u bytes after closing c", the summaries are chained, and each chunk
then numbers its own items. A summary is a step function of t. Where batches that start at different items fall into step, t does not matter
and one entry stands for many items. Where they do not, as in chunks lighter than the limit, what is left falls by just the bytes that the batch
starts later: one entry stands for these items too, and only their places are kept. A span of some limits in which batches do not fall
into step has as many outcomes as items within one limit, so it keeps as many entries; packed as differences they take a few bytes each. Neighbouring summaries combine into one of the same form, a few in a
task and in as many rounds as it takes, and the chain runs back down the rounds.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.scratch import stage

_NO_BATCH = -1  # entry state of the first chunk: no batch is open
_CHUNK_ROWS = 100_000
_SPAN = 16  # neighbouring summaries that one task combines or chains
_PART_BITS = 33  # of the running number within a partition
_PACKED = ("sums", "first", "closed", "base", "slope")  # of a summary, packed in a row


def _starts(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums before each item, and for a batch started at each item the start of the next one."""
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(len(sizes))
    return prefix, np.maximum(np.searchsorted(prefix, prefix[at] + limit, side="right") - 1, at + 1)


def _ends(prefix: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a batch started at each item: batches closed from there, bytes open at the end. Each round looks twice as far."""
    n = len(following)
    goes_on = following < n
    last, closed = np.where(goes_on, following, np.arange(n)), goes_on.astype(np.int64)
    while (further := closed[last]).any():
        closed, last = closed + further, last[last]
    return closed, prefix[n] - prefix[last]


_FLAT, _FALLS, _BOTH = 1, 2, 3  # how an item's outcome follows from that of the item before


def _packed(total: int, prefix: np.ndarray, closed: np.ndarray, left: np.ndarray) -> dict:
    """The summary that has an outcome for each item: ``left = base - slope * prefix`` in each run, which starts at item ``first`` of those kept."""
    equal = np.diff(closed) == 0
    step = np.where(equal & (np.diff(left) == 0), _FLAT, 0) + np.where(equal & (np.diff(left + prefix) == 0), _FALLS, 0)
    at = np.maximum.accumulate(np.where(step == _BOTH, 0, np.arange(len(step))))
    step = np.where((step == _BOTH) & (step[at] != _FALLS), _FLAT, step[at])  # items without bytes go on like those before
    starts = np.ones(len(prefix), dtype=bool)
    before = np.concatenate([step[:1], step[:-1]])
    starts[1:] = (step == 0) | ((step != before) & (before != 0))
    slope = np.append(step, 0)[starts] == _FALLS
    kept = starts | slope[np.cumsum(starts) - 1]
    return {
        "total": int(total),
        "sums": prefix[kept],
        "first": np.flatnonzero(starts[kept]),
        "closed": closed[starts],
        "base": left[starts] + slope * prefix[starts],
        "slope": slope.astype(np.int64),
    }


def _to_row(summary: dict) -> list:
    """The summary as it is shuffled: neighbouring entries differ little, so differences are compressed."""
    packed = (zlib.compress(np.diff(summary[c], prepend=0).astype("<i8").tobytes(), 1) for c in _PACKED)
    return [summary["total"], *packed]


def _from_row(row: dict) -> dict:
    unpacked = {c: np.cumsum(np.frombuffer(zlib.decompress(row[c]), "<i8")) for c in _PACKED}
    return {"_chunk": row["_chunk"], "total": row["total"], **unpacked}


def _outcomes(row: dict, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(closed, left)`` of a batch that starts at these of the kept items."""
    run = np.searchsorted(row["first"], at, side="right") - 1
    return row["closed"][run], row["base"][run] - row["slope"][run] * row["sums"][at]


def _chunk_summary(sizes: np.ndarray, limit: int) -> dict:
    """What a batch open on entry leads to, by the item that closes it: one within the first ``limit`` bytes."""
    prefix, following = _starts(sizes, limit)
    closed, left = _ends(prefix, following)
    items = min(int(np.searchsorted(prefix, limit, side="right")), len(sizes))
    return _packed(prefix[-1], prefix[:items], closed[:items], left[:items])


def _enter(states: np.ndarray, prefix: np.ndarray, limit: int) -> np.ndarray:
    """Item at which a batch open with so many bytes is closed; past the last if none does."""
    at = np.maximum(np.searchsorted(prefix, limit - states, side="right") - 1, 0)
    return np.where(states == _NO_BATCH, 0, at)


def _pass(row: dict, states: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """``(closed, states)`` after a chunk is entered with these bytes in the open batch."""
    closed, after = np.zeros(len(states), dtype=np.int64), states + row["total"]
    inside = (states == _NO_BATCH) | (after > limit)
    if inside.any():
        entered = states[inside]
        ended, after[inside] = _outcomes(row, _enter(entered, row["sums"], limit))
        closed[inside] = ended + (entered != _NO_BATCH)
    return closed, after


def _chain(
    rows: list[dict], state: int, first: int, limit: int, unpack: Callable[[dict], dict] = dict
) -> list[tuple[int, int, int]]:
    """``(chunk, state, first)`` on entry to each of the ordered chunks; one at a time is unpacked."""
    out, states = [], np.array([state], dtype=np.int64)
    for row in rows:
        out.append((row["_chunk"], int(states[0]), first))
        closed, states = _pass(unpack(row), states, limit)
        first += int(closed[0])
    return out


def _combine(rows: Iterable[dict], limit: int) -> dict:
    """Summary of ordered neighbouring chunks taken as one."""
    prefix = closed = left = np.empty(0, dtype=np.int64)
    total = 0
    for row in rows:
        more, left = _pass(row, left, limit)
        closed = closed + more
        if total <= limit:  # beyond, no item of this chunk closes a batch that was open before the first
            near = np.flatnonzero(row["sums"] <= limit - total)
            ended, remaining = _outcomes(row, near)
            prefix = np.concatenate([prefix, total + row["sums"][near]])
            closed, left = np.concatenate([closed, ended]), np.concatenate([left, remaining])
        total += row["total"]
    return _packed(total, prefix, closed, left)


def assign_batches(df: DataFrame, size: str, limit: int, order: str | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``batch_no``, counted from 0 within each ``by`` group along ``order``.

    The sorted rows are written once to the shared folder; after that, Python sees keys, order and sizes only, at most
    a chunk at a time, or ``_SPAN`` summaries of neighbouring chunks. Columns
    beyond those are joined back at the end. Rows that tie in ``order`` are taken in an arbitrary order.
    """
    order = [order] if isinstance(order, str) else list(order)
    by = list(by)
    numbered = df.orderBy(*by, *order).withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << _PART_BITS) - 1)}
    )
    rows = stage(numbered, "ordered")
    last_part, last_at = rows.agg(F.coalesce(F.max("_part"), F.lit(0)), F.coalesce(F.max("_at"), F.lit(0))).first()
    width = last_at // _CHUNK_ROWS + 1  # chunks of the longest partition
    chunk = F.col("_part").cast("bigint") * width + F.floor(F.col("_at") / _CHUNK_ROWS)
    own = list(dict.fromkeys([*by, *order, size]))
    narrow = rows.select(*own, "_part", "_at", chunk.alias("_chunk"), F.col(size).cast("bigint").alias("_size"))
    by_schema = T.StructType([df.schema[c] for c in by]).add("_chunk", T.LongType())
    summary_schema = T.StructType(
        [
            *by_schema.fields,
            T.StructField("total", T.LongType()),
            *(T.StructField(c, T.BinaryType()) for c in _PACKED),
        ]
    )
    entry_schema = T.StructType(
        [*by_schema.fields, T.StructField("_state", T.LongType()), T.StructField("_first", T.LongType())]
    )
    whole = set(own) == set(df.columns)
    kept = [df.schema[c] for c in own] if whole else [rows.schema["_part"], rows.schema["_at"]]
    out_schema = T.StructType([*kept, T.StructField("batch_no", T.LongType())])

    def summarise(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf.sort_values("_at")["_size"].to_numpy(dtype=np.int64)
        return pd.DataFrame([[*key, *_to_row(_chunk_summary(sizes, limit))]], columns=summary_schema.fieldNames())

    def combine(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = _combine(map(_from_row, pdf.sort_values("_chunk").to_dict("records")), limit)
        return pd.DataFrame([[*key, *_to_row(found)]], columns=summary_schema.fieldNames())

    def chained(pdf: pd.DataFrame, state: int, first: int) -> pd.DataFrame:
        head = [pdf[c].iloc[0] for c in by]
        found = _chain(pdf.sort_values("_chunk").to_dict("records"), state, first, limit, _from_row)
        return pd.DataFrame([[*head, *e] for e in found], columns=entry_schema.fieldNames())

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        return chained(pdf, _NO_BATCH, 0)

    def chain_within(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        return chained(pdf, int(entry["_state"].iloc[0]), int(entry["_first"].iloc[0]))

    def number(key: tuple, pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        sizes = pdf["_size"].to_numpy(dtype=np.int64)
        state, first = int(entry["_state"].iloc[0]), int(entry["_first"].iloc[0])
        prefix, following = _starts(sizes, limit)
        starts = np.zeros(len(sizes), dtype=np.int64)
        at = int(_enter(np.array(state), prefix, limit))
        while at < len(sizes):
            starts[at] = 1
            at = int(following[at])
        # the batch open on entry, or the first of all, carries the number ``first``
        offset = first - (1 if state == _NO_BATCH else 0)
        return pdf.assign(batch_no=np.cumsum(starts) + offset)[out_schema.fieldNames()]

    summaries = narrow.select(*by, "_chunk", "_at", "_size").groupBy(*by, "_chunk").applyInPandas(summarise, summary_schema)
    span, levels, n_chunks = F.floor(F.col("_chunk") / _SPAN).cast("bigint"), [], (last_part + 1) * width
    while n_chunks > _SPAN:
        levels.append(stage(summaries, "summaries"))
        spans = levels[-1].withColumn("_span", span).groupBy(*by, "_span")
        summaries, n_chunks = spans.applyInPandas(combine, summary_schema), -(-n_chunks // _SPAN)
    entries = summaries.groupBy(*(by or [F.lit(0).alias("_all")])).applyInPandas(chain, entry_schema)
    for level in reversed(levels):
        spans = level.withColumn("_span", span).groupBy(*by, "_span")
        entries = spans.cogroup(entries.groupBy(*by, "_chunk")).applyInPandas(chain_within, entry_schema)
    found = narrow.groupBy(*by, "_chunk").cogroup(entries.groupBy(*by, "_chunk")).applyInPandas(number, out_schema)
    if not whole:
        found = rows.join(found, ["_part", "_at"])
    return found.select(*df.columns, "batch_no")
