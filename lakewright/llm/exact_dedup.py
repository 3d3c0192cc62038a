"""Exact deduplication by distributed MSD radix partitioning.

Texts are parted by their length, and groups are split by their next bytes until a group has one member or its texts have
ended. A digit is a run of bytes whose width grows from level to level, so that a text of n bytes
takes a number of levels logarithmic in n. Members of a group that ended are byte for byte equal: every
byte took part in a split, and no digest stands in for any of them.

Each level counts ``(group, digit)`` with partial aggregation, so that copies merge before the
shuffle however many there are, and looks only at texts that still share all bytes so far. While the keys of those are few enough
to be broadcast (``rows.BROADCAST_ROWS``), nothing else moves: over all levels at most the bytes that documents of one length share with
others, and a third or so more. Beyond that each level also shuffles the next digit of all texts long enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.rows import broadcast_if_small, keyed
from lakewright.scratch import stage, staged

FIRST_WIDTH = 64  # bytes of the first digit
GROWTH = 16  # times the width of the digit before


def shared_texts(rows: DataFrame) -> DataFrame:
    """``rid, keep_rid, keep_id, group_size`` of every row of ``keyed`` rows whose text another row has too.

    ``keep_rid`` is the largest key of the group. Empty texts are equal to each other.
    """
    data = rows.select("rid", "id", F.col("text").cast("binary").alias("bytes"))
    going_on = None
    offset, width, ended = 0, FIRST_WIDTH, []
    while True:
        # texts too short for this level ended in the one before; only digits move
        group = [F.octet_length("bytes").cast("long").alias("g")] if going_on is None else []
        digits = data.where(F.octet_length("bytes") >= offset).select(
            "rid", "id", F.substring("bytes", offset + 1, width).alias("digit"), *group
        )
        grouped = digits if going_on is None else digits.join(broadcast_if_small(going_on), "rid")
        with staged(grouped, "digits") as cut:
            counted = cut.groupBy("g", "digit").agg(
                F.count("*").alias("group_size"), F.max("rid").alias("keep_rid"), F.max_by("id", "rid").alias("keep_id"), F.min("rid").alias("low")
            )
            with staged(counted.where("group_size > 1"), "groups") as groups:
                # a group's smallest key names it in the next level; both sides are plain reads, so a hot group can be split
                members = stage(
                    cut.join(groups, ["g", "digit"]).select(
                        "rid", F.col("low").alias("g"), "keep_rid", "keep_id", "group_size", (F.octet_length("digit") < width).alias("ended")
                    ),
                    "members",
                )
        ended.append(members.where("ended").select("rid", "keep_rid", "keep_id", "group_size"))
        going_on = members.where("not ended").select("rid", "g")
        if going_on.isEmpty():
            return reduce(DataFrame.unionByName, ended)
        offset, width = offset + width, width * GROWTH


def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None
) -> DataFrame:
    """``id, keep_id, group_size, kept`` per row, dropped ones too, and ``carry``: columns made from ``text``, the text itself unless given.

    What is carried is worked out before anything moves, so ask for a digest or a length rather than for whole texts.
    Texts are equal when their bytes are; a null text counts as empty, and all empty texts form a group.
    Of a group the row with the largest id stays. Where ids repeat, exactly one row of a group is kept
    and ``keep_id`` is its id; a null id is smaller than all others. An empty table gives no rows.
    """
    rows = keyed(df, id_col, text_col)
    carry = {"text": F.col("text")} if carry is None else carry
    carried = rows.select("rid", "id", *[value.alias(name) for name, value in carry.items()])
    return carried.join(shared_texts(rows), "rid", "left").select(
        "id",
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep_rid") == F.col("rid"), F.lit(True)).alias("kept"),
        *carry,
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; rules as in ``exact_groups``."""
    rows = keyed(df, id_col, text_col, whole=True)
    gone = stage(shared_texts(rows).where("rid <> keep_rid").select("rid"), "gone")
    return rows.join(broadcast_if_small(gone), "rid", "left_anti").select("row.*")
