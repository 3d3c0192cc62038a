"""Which words set the sources of a language apart, and how far sources lie from each other.

Counts per language, source and term are made by Spark; each language keeps the terms of at least ``min_docs`` of its
documents. A group (language and source) and its language give every kept term the share
``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``, N: kept occurrences there, V: kept terms of the language, and a
term divides two shares by ``floor((p - q)^2 / (p + q))``. All arithmetic is on whole numbers.

The strongest terms of a group are found without scoring all of them. Among terms whose share is above the language's, the
value rises with the group's count and falls with the language's, and ties go by UTF-8 order; so a term
that ``top`` others dominate in these three cannot be among the first ``top``. Each partition keeps the terms that
fewer dominate, its skyband; skybands are merged sixteen at a time in rounds, and what is left is ranked exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakewright.scratch import stage

MIN_DOCS, TOP = 10, 10
HELD = 500_000  # distinct terms that a task counts before it passes them on
FAN_IN = 16  # skybands merged by one task
SOURCES = 256  # of a language that one task compares with the others
CELLS = 1 << 17  # counts, terms times sources, that one task compares
SHARE = 1_000_000_000

#: Letters and all bytes beyond ASCII make up terms; other bytes part them, and A-Z become lower case.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_GROUP = ["lang", "source"]


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


def count_terms(rows: DataFrame, held: int = HELD) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents per group, of ``lang, source, text`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, size = {}, 0

        def counted() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                keys = list(n)
                for at in range(0, len(keys), 100_000):
                    part = keys[at : at + 100_000]
                    numbers = [pa.array(list(map(of.__getitem__, part)), pa.int64()) for of in (n, docs)]
                    group = [pa.repeat(pa.scalar(x, pa.string()), len(part)) for x in (lang, source)]
                    terms = pa.array(part, pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([*group, terms, *numbers], names=[*_GROUP, "term", "n", "docs"])

        for batch in batches:
            names = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, text in zip(names, batch.column("bytes")):
                terms = terms_of(text.as_py())
                n, docs = groups.get(group) or groups.setdefault(group, (Counter(), Counter()))
                before = len(n)
                n.update(terms)
                docs.update(set(terms))
                size += len(n) - before
                if size >= held:
                    yield from counted()
                    groups.clear()
                    size = 0
        yield from counted()

    parts = rows.select(*_GROUP, F.col("text").cast("binary").alias("bytes"))
    counts = parts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counts.groupBy(*_GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def skyband(terms: pa.Table, k: int) -> pa.Table:
    """The rows of ``term, n, lang_n`` that fewer than ``k`` others dominate: more ``n``, less ``lang_n``, earlier ``term``, none worse.

    Rows come in an order in which every row follows all that dominate it, and are compared, a block at a time, with
    those kept so far: a row with ``k`` dominators has ``k`` that are kept, as dominance is transitive.
    """
    order = [("n", "descending"), ("lang_n", "ascending"), ("term", "ascending")]
    terms = terms.take(pc.sort_indices(terms, sort_keys=order))
    if len(terms) <= k:
        return terms
    n, lang_n = terms["n"].to_numpy(), terms["lang_n"].to_numpy()
    begins = np.flatnonzero(np.r_[True, (n[1:] != n[:-1]) | (lang_n[1:] != lang_n[:-1])])
    within = np.arange(len(n)) - np.repeat(begins, np.diff(np.r_[begins, len(n)]))
    terms = terms.filter(pa.array(within < k))  # of equal counts the first k terms dominate the others
    lang_n = terms["lang_n"].to_numpy()
    rank = np.empty(len(terms), np.int64)
    rank[pc.sort_indices(terms["term"]).to_numpy()] = np.arange(len(terms))
    kept, block = np.empty(0, np.int64), 512
    for at in range(0, len(terms), block):
        here = np.arange(at, min(at + block, len(terms)))
        many = np.zeros(len(here), np.int64)
        for lo in range(0, len(kept), 4096):
            alive = many < k
            above = kept[lo : lo + 4096, None]
            many[alive] += ((lang_n[above] <= lang_n[here[alive]]) & (rank[above] < rank[here[alive]])).sum(0)
        here = here[many < k]
        many = many[many < k]
        inside = (lang_n[here][:, None] <= lang_n[here]) & (rank[here][:, None] < rank[here])
        many += np.triu(inside, 1).sum(0)
        kept = np.r_[kept, here[many < k]]
    return terms.take(pa.array(kept))


_BAND = "lang string, source string, term string, n long, lang_n long, part long"


def skybands(terms: DataFrame, k: int, held: int = HELD) -> DataFrame:
    """The skyband of each group of ``lang, source, term, n, lang_n`` rows: first per partition, then merged in rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, groups, size = TaskContext.get().partitionId(), {}, 0

        def reduced() -> int:
            for key, tables in groups.items():
                groups[key] = [skyband(pa.concat_tables(tables), k)]
            return sum(len(tables[0]) for tables in groups.values())

        limit = held
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = table.select(_GROUP).group_by(_GROUP).aggregate([])
            for lang, source in zip(keys["lang"].to_pylist(), keys["source"].to_pylist()):
                own = table.filter((pc.field("lang") == lang) & (pc.field("source") == source))
                groups.setdefault((lang, source), []).append(own.select(["term", "n", "lang_n"]))
            size += len(table)
            if size >= limit:
                size = reduced()
                limit = max(held, 2 * size)
        reduced()
        for (lang, source), (table,) in groups.items():
            fixed = [pa.repeat(pa.scalar(x, pa.string()), len(table)) for x in (lang, source)]
            columns = [*fixed, *table.columns, pa.repeat(pa.scalar(part, pa.int64()), len(table))]
            yield from pa.Table.from_arrays(columns, names=[*_GROUP, "term", "n", "lang_n", "part"]).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        fixed = table.slice(0, 1).select([*_GROUP, "part"])
        band = skyband(table.select(["term", "n", "lang_n"]), k)
        same = {c: pa.repeat(fixed[c][0], len(band)) for c in fixed.column_names}
        return pa.table([same["lang"], same["source"], *band.columns, same["part"]], names=[*_GROUP, "term", "n", "lang_n", "part"])

    bands = stage(terms.mapInArrow(run, _BAND), "skybands")
    parts = (bands.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        bands = bands.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy(*_GROUP, "part").applyInArrow(merge, _BAND)
        parts = -(-parts // FAN_IN)
    return bands.drop("part")


def share(count: str, total: str) -> Column:
    """The share of a count among ``total`` kept occurrences, for kept terms ``n_terms``."""
    return F.expr(f"1 + (cast({SHARE} as decimal(10, 0)) * ({count} + 2)) div ({total} + 2 * n_terms)")


def value(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``share`` in numpy: long division by three digits at a time keeps all numbers in 64 bits for totals below 9 * 10^15."""
    quotient, rest = divmod(counts + 2, totals)
    for _ in range(3):
        more, rest = divmod(rest * 1000, totals)
        quotient = quotient * 1000 + more
    return quotient + 1


def compare_sources(vectors: DataFrame, groups: DataFrame, width: int) -> DataFrame:
    """``lang, source, item, value`` of each two sources of a language, summed over all its kept terms.

    The terms of a language are dealt out among tasks of about ``CELLS`` counts, or as many as there are pairs if that is more, and so
    are blocks of its sources if there are more than ``width``; every task compares its block's sources with all
    others over its terms. Pairs are made once per task, not once per term, and added up.
    """
    langs = groups.groupBy("lang").agg(F.count("*").alias("n"), F.max("n_terms").alias("n_terms"))
    most, cells = langs.agg(F.max("n"), F.max(F.col("n") * F.col("n_terms"))).first()
    blocks, deals = max(1, -(-(most or 0) // width)), max(1, -(-(cells or 0) // max(CELLS, (most or 0) ** 2)))
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    terms = vectors.select("lang", F.pmod(F.xxhash64("term"), F.lit(deals)).cast("int").alias("deal"), "sources", each_block)
    block_of = F.pmod(F.xxhash64("source"), F.lit(blocks)).alias("own_block")
    sides = groups.select("*", block_of, each_block)
    sides = sides.select("*", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        names, block = right["source"].to_pylist(), right["block"][0]
        totals = right["total"].to_numpy() + 2 * right["n_terms"].to_numpy()
        mine = np.flatnonzero(pc.equal(pc.cast(right["own_block"], pa.int64()), pc.cast(block, pa.int64())).to_numpy())
        sums = np.zeros((len(mine), len(names)), np.int64)
        if len(left):
            lists = left["sources"].combine_chunks()
            entries = lists.flatten()
            rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            places = pc.index_in(entries.field("source"), pa.array(names, pa.string())).to_numpy(zero_copy_only=False)
            counts = entries.field("n").to_numpy()
            step = max(1, 1_000_000 // len(names))
            for lo in range(0, len(lists), step):
                a, b = np.searchsorted(rows, (lo, lo + step))
                dense = np.zeros((min(step, len(lists) - lo), len(names)), np.int64)
                dense[rows[a:b] - lo, places[a:b]] = counts[a:b]
                p = shares(dense, totals)
                for i, source in enumerate(mine):
                    q = p[:, [source]]
                    sums[i] += ((p - q) * (p - q) // (p + q)).sum(0)
        i, j = np.nonzero(mine[:, None] != np.arange(len(names)))
        own, named = pa.array(mine[i]), pa.array(names, pa.string())
        lang = pa.repeat(right["lang"][0], len(i))
        return pa.table([lang, named.take(own), named.take(pa.array(j)), pa.array(sums[i, j])], names=["lang", "source", "item", "value"])

    keys = ["lang", "deal", "block"]
    met = terms.groupBy(*keys).cogroup(sides.groupBy(*keys))
    found = met.applyInArrow(compare, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit_sources(
    df: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    width: int = SOURCES,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other sources, part ``term`` the ``top`` strongest terms.

    Null languages, sources and texts count as empty ones; each row is a document, repeated ids or not, and other columns are not
    looked at. A group without kept terms has its pairs and no terms; where a language keeps none, all its pairs
    have value 0. Equal values are ranked by the UTF-8 order of the item. An empty table gives no rows. The work on pairs grows with
    kept terms times the square of a language's sources, as the pairs themselves do with that square.
    """
    texts = {"lang": lang_col, "source": source_col, "text": text_col}
    rows = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for name, c in texts.items()))
    counts = count_terms(rows)
    by_term = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    vectors = stage(by_term.where(F.col("docs") >= min_docs).drop("docs"), "terms")
    entries = vectors.select("lang", "term", "lang_n", F.inline("sources"))
    langs = vectors.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_n").alias("lang_total"))
    totals = entries.groupBy(*_GROUP).agg(F.sum("n").alias("total"))
    groups = rows.select(*_GROUP).distinct().join(totals, _GROUP, "left").join(langs, "lang", "left")
    groups = stage(groups.fillna(0, ["total", "n_terms", "lang_total"]), "groups")

    strongest = skybands(entries, top).join(groups, _GROUP)
    strongest = strongest.withColumns({"p": share("n", "total"), "q": share("lang_n", "lang_total")}).where("p > q")
    terms = strongest.select(*_GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), value("p", "q").alias("value"))
    pairs = compare_sources(vectors, groups, width).select(*_GROUP, F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item")
    ranked = [found.withColumn("rank", F.row_number().over(order)) for found in (terms, pairs)]
    return ranked[0].where(F.col("rank") <= top).unionByName(ranked[1])
