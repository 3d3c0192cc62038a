"""Near-duplicates by MinHash with tensored banding, confirmed on whole shingle sets.

A table's key would be several minhashes put together, and each of the many tables its own. Here two small
collections of half keys are made instead, and a table's key is one half key of each: ``halves`` half keys a
side give ``halves**2`` tables for the minhashes of ``2 * halves`` half keys. A document keeps only half keys that another
one has too, so that nearly all documents drop out before any pair of halves is formed.

Documents with equal sets are one class and go on as their smallest member. Within a table's key the first and the last
document stand for the others: every other one is compared with those two, not with each other. Where a key
then still joins documents of different components, those documents are put through an exact filter on their rarest shingles
(``crossing``), which leaves out no link between components and, unlike the keys, is not met by texts that only share a
common passage: whether two sets can be linked by a shingle is decided once for all documents that hold it at equal places in
sets of equal size, before any two of them are joined. So a group of near copies costs as many comparisons as it has
members, and texts of one template that are not alike enough are never paired.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakewright.llm.rows import forget_in_worker, keyed, lean
from lakewright.scratch import stage


@dataclass(frozen=True)
class Settings:
    """Link at ``100 * shared >= percent * union``. At 75 % a pair misses all tables of these halves with a chance of 1 in 10,000."""

    words: int = 5
    percent: int = 75
    halves: int = 12
    per_half: int = 2  # minhashes
    seed: int = 11
    members: int = 500  # documents compared with one other in a task


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # odd multipliers of a public 64-bit finalizer


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """The ascending 64-bit hashes of a text's distinct shingles.

    Words are separated by bytes 9 to 13 and 32, A-Z count as lower case. A text with fewer
    words is one shingle of all of them, one without words has none.
    """
    key = xxhash.xxh3_64_intdigest
    own = np.array([key(w) for w in text.lower().split()], np.uint64)
    if not len(own):
        return own
    width = min(words, len(own))
    hashed = np.full(len(own) - width + 1, width, np.uint64)
    for k in range(width):
        hashed = _mixed(hashed + own[k : len(own) - width + 1 + k])
    return np.unique(hashed)


def half_keys(found: np.ndarray, settings: Settings) -> np.ndarray:
    """``2 * halves`` keys, each of ``per_half`` minhashes; the first half of them is one collection, the rest the other."""
    n = 2 * settings.halves * settings.per_half
    seeds = _mixed(np.arange(1, n + 1, dtype=np.uint64) * _M2 + np.uint64(settings.seed))
    lowest = np.empty(n, np.uint64)
    for k, seed in enumerate(seeds):
        lowest[k] = ((found ^ seed) * (_M1 ^ (seed << np.uint64(1)))).min()
    keys = np.zeros(2 * settings.halves, np.uint64)
    for part in lowest.reshape(-1, settings.per_half).T:
        keys = _mixed(keys + part)
    return keys.view(np.int64)


def signatures(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rid, n, digest, keys`` of ``keyed`` rows; digest and keys are null for a text without words."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_in_worker()
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column("bytes"):
                found = shingles(text.as_py(), settings.words)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(half_keys(found, settings) if len(found) else None)
            arrays = [batch.column("rid"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["rid", "n", "digest", "keys"])

    data = rows.select("rid", F.col("text").cast("binary").alias("bytes"))
    return data.mapInArrow(run, "rid long, n long, digest binary, keys array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are alike enough. ``texts``: ``rid, bytes`` of all that occur.

    The others come to ``a`` in sets of limited size, one after the other, so a task holds two texts at a time.
    """
    pairs = stage(pairs, "pairs")
    many = stage(pairs.groupBy("a").count().where(F.col("count") > settings.members), "many")
    sets = F.coalesce(F.ceil(F.col("count") / settings.members), F.lit(1))
    dealt = pairs.join(many, "a", "left").select("a", F.pmod(F.xxhash64("b"), sets).alias("part"), "b")
    asked = dealt.select("a", "part", F.col("b").alias("rid"), F.lit(1).alias("other")).unionByName(
        dealt.select("a", "part").distinct().select("a", "part", F.col("a").alias("rid"), F.lit(0).alias("other"))
    )

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_in_worker()
        first = None
        for batch in batches:
            links = []
            a, rid, other = (batch.column(c).to_pylist() for c in ("a", "rid", "other"))
            for i, text in enumerate(batch.column("bytes")):
                found = shingles(text.as_py(), settings.words)
                if not other[i]:
                    first = found
                    continue
                shared = len(np.intersect1d(first, found, assume_unique=True))
                if 100 * shared >= settings.percent * (len(first) + len(found) - shared):
                    links.append((a[i], rid[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    placed = asked.join(texts, "rid").repartition("a", "part").sortWithinPartitions("a", "part", "other")
    return placed.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``rid, component``: for every end of a link the smallest key it can reach.

    Alternates two steps that hang the neighbours of a node below the smallest of them, first the
    larger ones, then the smaller ones, until all hang on one: a number of rounds logarithmic in the longest chain.
    """

    def both_ways(edges: DataFrame) -> DataFrame:
        return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def lowest(side: DataFrame) -> DataFrame:
        """``a, m, below, above``: the smallest of a node and its neighbours, how many are smaller, whether one is larger."""
        smallest = F.least(F.min("b"), F.first("a")).alias("m")
        below, above = F.sum((F.col("b") < F.col("a")).cast("long")), F.max(F.col("b") > F.col("a"))
        return stage(side.groupBy("a").agg(smallest, below.alias("below"), above.alias("above")), "lowest")

    def hung(below: DataFrame, low: DataFrame, itself: bool) -> DataFrame:
        moved = below.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if itself:
            moved = moved.unionByName(low.select("a", F.col("m").alias("b")))
        return stage(moved.where("a <> b").distinct(), "edges")

    edges = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        low = lowest(both_ways(edges))
        if low.where("below > 1 or (below > 0 and above)").isEmpty():  # all hang on one node each, and those on none
            break
        edges = hung(both_ways(edges).where("b > a"), low, itself=False)
        edges = hung(edges, lowest(edges), itself=True)
    flat = edges.select(F.col("a").alias("rid"), F.col("b").alias("component"))
    return flat.unionByName(flat.select(F.col("component").alias("rid"), "component").distinct())


def table_keys(signs: DataFrame, settings: Settings) -> DataFrame:
    """``key, rid, n``: a document's keys in all tables, from half keys that other documents share."""
    halves = signs.select("rid", "n", F.posexplode("keys").alias("half", "value"))
    shared = stage(halves.groupBy("half", "value").count().where("count > 1").select("half", "value"), "shared_halves")
    own = halves.join(shared, ["half", "value"]).groupBy("rid", "n").agg(F.collect_list(F.struct("half", "value")).alias("own"))
    left = F.filter("own", lambda h: h["half"] < settings.halves)
    right = F.filter("own", lambda h: h["half"] >= settings.halves)
    sides = own.select("rid", "n", left.alias("left"), right.alias("right")).where("size(left) > 0 and size(right) > 0")
    pairs = sides.select("rid", "n", "right", F.explode("left").alias("l")).select("rid", "n", "l", F.explode("right").alias("r"))
    return pairs.select(F.xxhash64("l.half", "r.half", "l.value", "r.value").alias("key"), "rid", "n")


def sizes_fit(n: Column, m: Column, settings: Settings) -> Column:
    """Whether sets of these sizes can be linked at all."""
    return 100 * F.least(n, m) >= settings.percent * F.greatest(n, m)


def alike(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rid, n, component`` of ``keyed`` rows: shingles, and the smallest key among all that links lead to."""
    signs = stage(signatures(rows, settings), "signatures")
    classes = stage(signs.where("digest is not null").groupBy("digest").agg(F.min("rid").alias("first"), F.count("*").alias("size")), "classes")
    of_class = signs.select("rid", "n", "digest").join(classes.where("size > 1").select("digest", "first"), "digest", "left")
    members = of_class.select("rid", "n", F.coalesce("first", "rid").alias("first"))
    leaders = signs.join(classes.select(F.col("first").alias("rid")), "rid")  # one of each class

    tables = stage(table_keys(leaders, settings), "tables")
    lowest, highest = (F.min("rid").alias("low"), F.min_by("n", "rid").alias("low_n")), (F.max("rid").alias("high"), F.max_by("n", "rid").alias("high_n"))
    ends = tables.groupBy("key").agg(*lowest, *highest).where("low < high")
    held = stage(tables.join(stage(ends, "ends"), "key"), "held")

    involved = held.select("rid").distinct()
    texts = stage(rows.select("rid", F.col("text").cast("binary").alias("bytes")).join(involved, "rid"), "candidate_texts")
    stars = held.select(F.col("low").alias("a"), F.col("low_n").alias("n_a"), F.col("rid").alias("b"), F.col("n").alias("n_b")).unionByName(
        held.select(F.col("rid").alias("a"), F.col("n").alias("n_a"), F.col("high").alias("b"), F.col("high_n").alias("n_b"))
    )
    fitting = stars.where((F.col("a") != F.col("b")) & sizes_fit(F.col("n_a"), F.col("n_b"), settings))
    links = stage(confirmed(fitting.select("a", "b").distinct(), texts, settings), "links")
    joined = components(links)

    # keys that still hold documents of several components
    labelled = held.select("key", "rid").join(joined, "rid", "left").select("key", "rid", F.coalesce("component", "rid").alias("c"))
    labelled = stage(labelled, "labelled")
    mixed = labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    still_open = stage(labelled.join(stage(mixed, "mixed"), "key").select("rid", "c").distinct(), "open")
    more = stage(confirmed(crossing(still_open, texts, settings), texts, settings), "links")
    final = joined
    if not more.isEmpty():
        final = components(joined.select(F.col("rid").alias("a"), F.col("component").alias("b")).unionByName(more))
    final = final.withColumnRenamed("rid", "first")
    return members.join(final, "first", "left").select("rid", "n", F.coalesce("component", "first").alias("component"))


def meeting_cells(held: DataFrame, settings: Settings) -> DataFrame:
    """``value, n_x, at_x, n_y, at_y``: a place in smaller sets that is worth comparing with one in sets as large or larger.

    ``held``: ``value, c, n, at, narrow``. Two places of one and the same component are not worth it. Sizes that can be linked lie
    in the same or in neighbouring bands, so that a shingle's cells are joined with cells of about their own size only.
    """
    width = max(math.log(100 / settings.percent) * 1.001, 0.01)
    band = F.floor(F.log("n") / width).cast("int")
    cells = held.groupBy("value", "n", "at", "narrow").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    cells = stage(cells.withColumn("band", band), "cells")
    x = cells.where("narrow").withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    x = x.select("value", "band", *(F.col(k).alias(f"{k}_x") for k in ("n", "at", "lo", "hi")))
    y = cells.select("value", "band", *(F.col(k).alias(f"{k}_y") for k in ("n", "at", "lo", "hi")))
    n_x, n_y = F.col("n_x"), F.col("n_y")
    needed = F.ceil((n_x + n_y) * settings.percent / (100 + settings.percent))
    enough = 1 + F.least(n_x - F.col("at_x"), n_y - F.col("at_y")) >= needed
    apart = F.least("lo_x", "lo_y") < F.greatest("hi_x", "hi_y")
    met = x.join(y, ["value", "band"]).where((n_x <= n_y) & sizes_fit(n_x, n_y, settings) & enough & apart)
    return met.select("value", "n_x", "at_x", "n_y", "at_y")


def crossing(docs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """``a, b``: every pair of the ``rid, c`` rows that may be linked and lies in two components ``c``, and few others.

    With all sets in one order, rarest shingles first, two sets that are alike enough share one within their first
    few: of the smaller set, those that may lie outside the required overlap with an equally large one (its narrow
    prefix), of the larger one, outside the least overlap it can be linked by (its wide prefix). What comes after
    the first shared shingle must suffice for the rest of the overlap. A shingle of one document only takes a place in this
    order and nothing else.

    Only sizes and places decide whether a narrow and a wide prefix meet in a shingle. So that is settled for cells, all
    documents that hold a shingle at the same place in sets of the same size; documents are joined by cells that meet.
    """
    percent = settings.percent

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("bytes")):
                found = shingles(text.as_py(), settings.words)
                same = [pa.array(np.full(len(found), x)) for x in (rid, len(found))]
                yield pa.RecordBatch.from_arrays([same[0], pa.array(found.view(np.int64)), same[1]], names=["rid", "value", "n"])

    found = texts.join(docs.select("rid"), "rid").select("rid", "bytes").mapInArrow(run, "rid long, value long, n long")
    found = stage(found, "shingles")
    shared = stage(found.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "shared_shingles")
    own = Window.partitionBy("rid")
    before = F.col("n") - F.count("*").over(own)  # shingles that no other document has
    ranked = found.join(shared, "value").withColumn("at", before + F.row_number().over(own.orderBy("df", "value")))
    first = ranked.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    first = stage(first.join(docs, "rid").select("value", "rid", "c", "n", "at"), "prefixes")
    # the largest component that holds a shingle need not meet itself
    counted = first.groupBy("value", "c").count().groupBy("value")
    largest = counted.agg(F.max_by("c", "count").alias("largest"), F.count("*").alias("several")).where("several > 1")
    held = stage(first.join(stage(largest.select("value", "largest"), "largest"), "value"), "meeting")
    narrow = F.col("at") <= F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1
    met = stage(meeting_cells(held.withColumn("narrow", narrow), settings), "meeting_cells")
    x = held.where(narrow).select("value", *(F.col(k).alias(f"{k}_x") for k in ("n", "at", "rid", "c")), "largest")
    y = held.select("value", *(F.col(k).alias(f"{k}_y") for k in ("n", "at", "rid", "c")), "largest")
    few_x, few_y = x.where("c_x <> largest"), y.where("c_y <> largest")

    def paired(x: DataFrame, y: DataFrame) -> DataFrame:
        joined = x.drop("largest").join(met, ["value", "n_x", "at_x"]).join(y.drop("largest"), ["value", "n_y", "at_y"])
        return joined.where("c_x <> c_y").select("rid_x", "rid_y")

    pairs = paired(few_x, y).unionByName(paired(x.where("c_x = largest"), few_y))
    return pairs.select(F.least("rid_x", "rid_y").alias("a"), F.greatest("rid_x", "rid_y").alias("b")).distinct()


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``id, n_shingles, component_id, kept`` per row; of each component the row with the smallest id is kept.

    A null or empty text, or one without words, has no shingles and is linked with nothing. Of rows with equal ids each is a
    document; a null id is the smallest. Equal sets are always linked. An empty table gives no rows.
    """
    rows = keyed(df, id_col, text_col)
    found = alike(rows, settings)
    ids = rows.select("rid", "id")
    named = found.join(ids, "rid").join(ids.select(F.col("rid").alias("component"), F.col("id").alias("component_id")), "component")
    return named.select("id", F.col("n").alias("n_shingles"), "component_id", (F.col("rid") == F.col("component")).alias("kept"))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; rules as in ``near_groups``."""
    rows = keyed(df, id_col, text_col, whole=True)
    gone = alike(rows.select("rid", "id", "text"), settings).where("rid <> component").select("rid")
    return rows.join(gone, "rid", "left_anti").select("row.*")
