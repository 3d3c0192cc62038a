"""Reproducible shuffle into shards by a Feistel permutation over global row numbers.

Rows are numbered by id. A keyed permutation of 0..n-1 gives every row its place in the shuffled order;
place p lies in shard ``p % shards`` at slot ``p // shards``. Shard sizes so differ by one row at most, slots have no
gaps, and both follow from the row's number, n and the seed alone: ``place_of`` computes them without Spark.

The permutation works on the numbers below side**2, side being the root of n rounded up. A number is the pair
(left, right) of its digits to that base; a round turns it into (right, left + f(round, right) mod side), which can
be undone for any f. Fewer than 2 * side numbers are not below n; a row that lands on one goes on from there until it
is below n (cycle walking), which again gives a permutation.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.rows import fresh, keyed, number_rows

ROUNDS = 4
HEX_DIGITS = 12  # of the round function's digest: 48 bits
MOST_WALKS = 100  # a walk of t steps has probability below (2 / side)**t, and for side <= 50 cannot be longer


def place_of(row_no: int, n: int, seed: int = 0) -> int:
    """Where row ``row_no`` of ``n`` goes in the shuffled order."""
    side = math.isqrt(n - 1) + 1
    while True:
        left, right = divmod(row_no, side)
        for r in range(ROUNDS):
            digest = hashlib.md5(f"{seed}:{r}:{right}".encode(), usedforsecurity=False).hexdigest()
            left, right = right, (left + int(digest[:HEX_DIGITS], 16)) % side
        row_no = left * side + right
        if row_no < n:
            return row_no


def _permuted(x: Column, side: int, seed: int) -> Column:
    """One pass of all rounds over a column of numbers below side**2."""

    def turn(pair: Column, r: Column) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), r.cast("string"), pair["right"].cast("string"))
        f = F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX_DIGITS), 16, 10).cast("long")
        return F.struct(pair["right"].alias("left"), ((pair["left"] + f) % side).alias("right"))

    start = F.struct(F.floor(x / F.lit(side)).cast("long").alias("left"), (x % side).alias("right"))
    rounds = F.array(*[F.lit(r) for r in range(ROUNDS)])
    return F.aggregate(rounds, start, turn, lambda pair: pair["left"] * side + pair["right"])


def with_place(rows: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``rows`` of the columns ``row_no`` and others, with ``place``: ``place_of`` each of the ``n`` rows.

    Only rows that the first pass puts outside 0..n-1 walk on.
    """
    side = math.isqrt(max(n, 1) - 1) + 1
    landed = F.col("_landed")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST_WALKS)),
        landed,
        lambda at, _: F.when(at < n, at).otherwise(_permuted(at, side, seed)),
    )
    # a walk that long does not happen; should it, better fail than place two rows alike
    checked = F.when(F.col("place") < n, F.col("place")).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))
    return (
        rows.withColumn("_landed", _permuted(F.col("row_no"), side, seed))
        .withColumn("place", F.when(landed < n, landed).otherwise(walked))
        .withColumn("place", checked)
        .drop("_landed")
    )


def shard(
    df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 0
) -> DataFrame:
    """``id, size, text_crc32, row_no, place, shard, slot`` per row; ``size`` is the text's UTF-8 bytes plus 1.

    Row counts of shards differ by one at most (law ``rows``); with fewer rows than shards some shards are empty. Null
    texts have size 1 and the checksum of nothing. Rows with equal or null ids are placed apart like any others;
    which of them has which number is arbitrary. An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    bytes_of = F.col("text").cast("binary")
    narrow = keyed(df, id_col, text_col).select(
        "rid", "id", (F.octet_length(bytes_of) + 1).cast("long").alias("size"), F.crc32(bytes_of).alias("text_crc32")
    )
    rows, n = number_rows(narrow, "rid")
    return with_place(rows, n, seed).select(
        "id", "size", "text_crc32", "row_no", "place",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"),
    )


def write_shards(df: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> None:
    """Write whole rows to a folder per shard, each file a run of its slots in order; many tasks share a large shard."""
    rows = keyed(df, id_col, text_col, whole=True)
    part, slot = fresh(df, "shard"), fresh(df, "slot")
    places = shard(rows.select("rid", "text"), shards, "rid", "text", seed)
    places = places.select(F.col("id").alias("rid"), F.col("shard").alias(part), F.col("slot").alias(slot))
    out = rows.select("rid", "row").join(places, "rid").select("row.*", part, slot)
    out.repartitionByRange(part, slot).sortWithinPartitions(part, slot).write.partitionBy(part).parquet(path)
