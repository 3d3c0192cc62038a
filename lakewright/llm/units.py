"""Which units (lines, chunks) of a document an earlier document holds too.

Shared by line and substring deduplication. A unit is known by a 128-bit digest. Documents give each
of their digests once; counting merges them before the shuffle, so a unit that every document holds
costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.rows import forget_in_worker, lean, pieces
from lakewright.scratch import stage

DIGEST = 16  # bytes of a digest


def held_units(rows: DataFrame, digests: Callable[[bytes], list[bytes]]) -> DataFrame:
    """``rid, unit``: the distinct digests of each of ``keyed`` rows."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_in_worker()
        for batch in (piece for whole in batches for piece in pieces(whole, "bytes")):
            rids, counts, units = batch.column("rid").to_numpy(), [], []
            for text in batch.column("bytes"):
                own = set(digests(text.as_py()))
                counts.append(len(own))
                units.extend(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(rids, counts)), pa.array(units, pa.binary())], names=["rid", "unit"]
            )

    return rows.select("rid", F.col("text").cast("binary").alias("bytes")).mapInArrow(run, "rid long, unit binary")


def repeated_units(held: DataFrame, min_docs: int) -> DataFrame:
    """``rid, units``: the digests that at least ``min_docs`` documents hold, for each but the smallest of those."""
    held = stage(held, "units")
    often = stage(
        held.groupBy("unit")
        .agg(F.count("*").alias("n"), F.min("rid").alias("first"))
        .where(F.col("n") >= min_docs)
        .select("unit", "first"),
        "repeated",
    )
    # both sides are plain reads, so that a unit held by very many documents can be split among tasks
    return held.join(often, "unit").where("rid <> first").groupBy("rid").agg(F.collect_list("unit").alias("units"))
