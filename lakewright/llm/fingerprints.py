"""Document fingerprints: a Merkle tree over sections, paragraphs and runs of words, in DataFrame functions only.

A text falls into sections at blank lines, a section into paragraphs at line feeds, a paragraph into runs of a few
words. Every cut is undone by putting its separator back, so the tree stands for the whole text. A leaf is the
SHA-256 of its run; a node is that of its children's digests. Equal roots so mean equal texts, and where roots
differ the edit lies below the sections, paragraphs and runs that differ.

A fingerprint is a string: the root in full, then all nodes in the order of the text, shortened to what comparing two
documents takes: ``R<64 hex> S<16 hex> P<16 hex> L<8 hex> ...``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakewright.llm.rows import keyed

RUN_WORDS = 8
BUCKETS_PER_PARTITION = 4  # neighbours meet in so many buckets for each shuffle partition


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def tree(text: Column) -> Column:
    """``array<array<array<leaf digest>>>``: sections, paragraphs, leaves.

    Each level is bound as a lambda's variable, so no split is worked out again for each of its elements.
    """

    def leaves(words: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / F.lit(RUN_WORDS)).cast("int"))
        return F.transform(runs, lambda i: _digest(F.array_join(F.slice(words, i * RUN_WORDS + 1, F.lit(RUN_WORDS)), " ")))

    def paragraphs(section: Column) -> Column:
        words = F.transform(F.split(section, "\n", -1), lambda paragraph: F.split(paragraph, " ", -1))
        return F.transform(words, leaves)

    return F.transform(F.split(text, "\n\n", -1), paragraphs)


def fingerprint(text: Column) -> Column:
    """The fingerprint string of a text column; null in, null out."""

    def paragraph(leaves: Column) -> Column:
        short = F.array_join(F.transform(leaves, lambda leaf: F.concat(F.lit(" L"), F.substring(leaf, 1, 8))), "")
        return F.struct(_digest(F.array_join(leaves, "")).alias("digest"), short.alias("below"))

    def node(letter: str):
        def build(children: Column) -> Column:
            below = F.transform(children, lambda c: F.concat(F.lit(f" {letter}"), F.substring(c["digest"], 1, 16), c["below"]))
            digest = _digest(F.array_join(F.transform(children, lambda c: c["digest"]), ""))
            return F.struct(digest.alias("digest"), F.array_join(below, "").alias("below"))

        return build

    sections = F.transform(tree(text), lambda s: F.transform(s, paragraph))
    root = F.transform(F.array(F.transform(sections, node("P"))), node("S"))[0]
    # bound once more, for both parts of the string
    return F.transform(F.array(root), lambda r: F.concat(F.lit("R"), r["digest"], r["below"]))[0]


def likeness(a: Column, b: Column) -> Column:
    """Shared nodes over all nodes of two fingerprints, 0 to 1; 1 only if the roots agree and so the texts are equal."""
    left, right = F.split(a, " "), F.split(b, " ")
    return F.size(F.array_intersect(left, right)) / F.size(F.array_union(left, right))


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Digests of the paragraphs of one fingerprint that the other lacks: where the texts differ."""

    def own(f: Column) -> Column:
        return F.filter(F.split(f, " "), lambda n: n.startswith("P"))

    return F.array_except(own(a), own(b))


def bucket_of(rid: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds lie below ``rid``, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast("long") for b in bounds])

    def step(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / F.lit(2)).cast("int")
        below = (s["low"] < s["high"]) & (F.get(table, middle) < rid)
        return F.struct(
            F.when(below, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(below | (s["low"] >= s["high"]), s["high"]).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(math.ceil(math.log2(len(bounds) + 1)) + 1))
    return F.aggregate(steps, start, step, lambda s: s["low"])


def with_next(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``keyed`` rows with ``columns`` added, and each of these and ``text`` also as ``next_*`` of the row of next smaller key.

    The row of the smallest key is followed by that of the largest. Rows meet in buckets of
    neighbouring keys with about as many rows each; of every bucket the first row is also sent to the one
    it follows on. What the driver gets is one number per bucket.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * BUCKETS_PER_PARTITION
    shares = [i / n for i in range(1, n)]
    bounds = rows.agg(F.percentile_approx("rid", shares, 10 * n)).first()[0]
    bucket = bucket_of(F.col("rid"), sorted(set(bounds or [])))
    placed = rows.withColumn("bucket", bucket)
    firsts = placed.groupBy("bucket").agg(F.max("rid").alias("rid")).orderBy("bucket").collect()
    # the first row of a bucket follows the last of the bucket above it; the very first follows the very last
    targets = [above.bucket for above in firsts[1:] + firsts[:1]]
    schema = "rid long, also int"
    follows = spark.createDataFrame([(row.rid, to) for row, to in zip(firsts, targets)], schema)
    sent = placed.join(F.broadcast(follows), "rid", "left")  # one row per bucket
    both = F.when(F.col("also").isNull(), F.array(F.struct(F.col("bucket").alias("to"), F.lit(0).alias("guest")))).otherwise(
        F.array(
            F.struct(F.col("bucket").alias("to"), F.lit(0).alias("guest")),
            F.struct(F.col("also").alias("to"), F.lit(1).alias("guest")),
        )
    )
    moved = sent.select("rid", "id", "text", F.inline(both)).repartition("to").withColumns(columns)
    order = Window.partitionBy("to").orderBy("guest", F.desc("rid"))
    following = {f"next_{c}": F.lead(c).over(order) for c in ("text", *columns)}
    return moved.withColumns(following).where("guest = 0").drop("to", "guest")


def compare_with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The edited text has the last third of its code points, rounded down, replaced by as many from the start of
    the document of next smaller id, or by all of that if it is shorter. Null and empty texts have one empty leaf.
    Ids sort nulls first; rows of equal id follow each other in a fixed arbitrary order. A single
    row is followed by itself. An empty table gives no rows.
    """
    rows = with_next(keyed(df, id_col, text_col), {"fingerprint": fingerprint(F.col("text"))})
    third = F.floor(F.length("text") / F.lit(3)).cast("int")
    start = F.substring(F.col("text"), F.lit(1), F.length("text") - third)
    edited = rows.withColumn("edited", F.concat(start, F.substring(F.col("next_text"), F.lit(1), third)))
    marked = edited.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return marked.select(
        "id", F.length("text").cast("long").alias("n_chars"), "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
