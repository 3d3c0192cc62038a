"""What five document filters remove, alone and in every order.

Texts are measured by a byte transducer: the class of a byte and whether a word goes on say what it adds to the counts of code points,
capitals and symbols and where a word begins or ends. Its state depends on the byte before alone, so the tables are looked up
for all bytes of a block of texts at once. Word spans go into one hash table per block, whose key
is the text and the word; a span counts as known only if its bytes equal those of the span found there, so no collision
changes a count. What a text fails is five bits, and the audit is sums over the 32 sets of failures per part.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILTERS = "ABCDE"
BLOCK = 4 << 20  # bytes of text measured at once; longer texts are measured piece by piece
LONG_WORD = 4096  # bytes; longer words are hashed and compared whole

# Classes of bytes, states (between words, inside a word) and what a step gives.
_BLANK, _CAPITAL, _SYMBOL, _FURTHER, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _BLANK
_CLASS[0x41:0x5B] = _CAPITAL
_CLASS[list(b"#$%&*|")] = _SYMBOL
_CLASS[0x80:0xC0] = _FURTHER
_NEXT = np.array([c != _BLANK for c in range(5)], np.uint8)
_BEGINS, _POINT, _UPPER, _SIGN = 1, 2, 4, 8
_STEP = np.array(
    [[_BEGINS * (c != _BLANK and not inside) | _POINT * (c != _FURTHER) | _UPPER * (c == _CAPITAL) | _SIGN * (c == _SYMBOL) for c in range(5)] for inside in (0, 1)],
    np.uint8,
)

_EIGHT = np.array([0, *((1 << 8 * n) - 1 for n in range(1, 8)), (1 << 64) - 1], np.uint64)  # the low n bytes
_MIX = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class WordTable:
    """Distinct words of texts that lie one after another in ``data``; ``begins``, ``ends`` and ``texts`` say where each word lies and whose it is."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, texts: np.ndarray, bits: int = 64) -> None:
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[: len(data)] = data
        self.at = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        self.data, self.begins, self.lengths, self.texts = data, begins, ends - begins, texts
        # words of up to 16 bytes are wholly told by their length, first and last eight bytes
        self.first = self.at[begins] & _EIGHT[np.minimum(self.lengths, 8)]
        self.last = np.where(self.lengths > 8, self.at[np.maximum(ends - 8, 0)], np.uint64(0))
        self.inserted = self._insert(self._hashes() & _EIGHT[8] >> np.uint64(64 - bits))

    def bytes_of(self, word: int) -> bytes:
        return self.data[self.begins[word] : self.begins[word] + self.lengths[word]].tobytes()

    def _hashes(self) -> np.ndarray:
        h = _mixed(self.first ^ (self.texts * self.lengths).astype(np.uint64) * _MIX)
        h = _mixed(h ^ self.last ^ self.texts.astype(np.uint64))
        more, j = np.flatnonzero((self.lengths > 16) & (self.lengths <= LONG_WORD)), 8
        while len(more := more[self.lengths[more] - 8 > j]):
            h[more] = _mixed(h[more] ^ self.at[self.begins[more] + j])
            j += 8
        for word in np.flatnonzero(self.lengths > LONG_WORD):
            h[word] ^= np.uint64(int.from_bytes(hashlib.blake2b(self.bytes_of(word), digest_size=8).digest(), "little"))
        return h

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words ``a`` are words ``b`` of the same texts, byte by byte."""
        same = (a == b) | (
            (self.texts[a] == self.texts[b]) & (self.lengths[a] == self.lengths[b]) & (self.first[a] == self.first[b]) & (self.last[a] == self.last[b])
        )
        open_ = np.flatnonzero(same & (a != b) & (self.lengths[a] > 16))
        for i in open_[self.lengths[a[open_]] > LONG_WORD]:
            same[i] = self.bytes_of(a[i]) == self.bytes_of(b[i])
        open_, j = open_[self.lengths[a[open_]] <= LONG_WORD], 8
        while len(open_ := open_[self.lengths[a[open_]] - 8 > j]):
            differs = self.at[self.begins[a[open_]] + j] != self.at[self.begins[b[open_]] + j]
            same[open_[differs]] = False
            open_, j = open_[~differs], j + 8
        return same

    def _insert(self, hashes: np.ndarray) -> np.ndarray:
        """One word of each distinct one. All words look at their places together; who meets another word looks at the next place."""
        size = 1 << max(4, (2 * len(hashes)).bit_length())
        table, mask = np.full(size, -1, np.int64), np.uint64(size - 1)
        words, places = np.arange(len(hashes)), (hashes & mask).astype(np.int64)
        while len(words):
            free = table[places] < 0
            table[places[free]] = words[free]
            other = ~self._equal(words, table[places])
            words, places = words[other], (places[other] + 1) % size
        return table[table >= 0]


def measure_block(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, WordTable]:
    """Words, capitals, code points and symbols (rows) of the texts in ``data`` between ``offsets``, and their distinct words."""
    n, size = len(offsets) - 1, len(data)
    kinds = _CLASS[data]
    inside = np.zeros(size + 1, np.uint8)  # the state in front of each byte, and behind the last
    inside[1:] = _NEXT[kinds]
    after = inside[1:].copy()  # the state behind each byte, for which the text goes on
    borders = offsets[1:-1]
    inside[borders[borders < size]] = 0
    steps = _STEP.ravel()[inside[:-1] * np.uint8(5) + kinds]
    begins = np.flatnonzero(steps & _BEGINS)
    follows = np.zeros(size, bool)  # whether a word goes on behind a byte
    follows[:-1] = _NEXT[kinds[1:]] & (inside[1:-1] == after[:-1])
    ends = np.flatnonzero(after.astype(bool) & ~follows) + 1

    def counted(places: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(places, offsets))

    points = np.diff(offsets) - counted(np.flatnonzero(~steps & _POINT))
    counts = np.stack([counted(begins), counted(np.flatnonzero(steps & _UPPER)), points, counted(np.flatnonzero(steps & _SIGN))])
    return counts, WordTable(data, begins, ends, np.repeat(np.arange(n), counts[0]))


def measure_long(data: np.ndarray, block: int) -> np.ndarray:
    """``words, capitals, points, symbols, distinct`` of one text, by pieces that end with a blank where there is one."""
    totals, known, at = np.zeros(4, np.int64), set(), 0
    while at < len(data):
        end = min(len(data), at + block)
        while end < len(data):  # no word is cut
            blanks = np.flatnonzero(_CLASS[data[at:end]] == _BLANK)
            if len(blanks):
                end = at + int(blanks[-1]) + 1
                break
            end = min(len(data), end + block)
        counts, table = measure_block(data[at:end], np.array([0, end - at]))
        totals += counts[:, 0]
        known.update(map(table.bytes_of, table.inserted))
        at = end
    return np.r_[totals, len(known)]


def measure(texts: list[bytes], block: int = BLOCK) -> np.ndarray:
    """Five rows, ``words, capitals, points, symbols, distinct``, with a column per UTF-8 text."""
    out = np.zeros((5, len(texts)), np.int64)
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= block):
            size, hi = size + len(texts[hi]), hi + 1
        data = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
        if size > block:
            out[:, lo] = measure_long(data, block)
        else:
            offsets = np.cumsum([0, *map(len, texts[lo:hi])])
            out[:4, lo:hi], table = measure_block(data, offsets)
            out[4, lo:hi] = np.bincount(table.texts[table.inserted], minlength=hi - lo)
        lo = hi
    return out


def measured(rows: DataFrame) -> DataFrame:
    """``n_words, n_capitals, n_chars, n_symbols, n_distinct, digest`` in place of ``text``; the digest has 128 bits."""
    names = ["n_words", "n_capitals", "n_chars", "n_symbols", "n_distinct"]
    others = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.as_py() for text in batch.column("bytes")]
            digests = [hashlib.blake2b(text, digest_size=16).digest() for text in texts]
            columns = [batch.column(c) for c in others] + [pa.array(row) for row in measure(texts)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.binary())], names=[*others, *names, "digest"])

    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)
    schema = ", ".join([kept, *(f"{c} long" for c in names), "digest binary"])
    return rows.select(*others, F.col("text").cast("binary").alias("bytes")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Limits:
    """A text fails A, B and C by these limits, D by a symbol, E if a smaller id has the same text."""

    words: int = 100  # A: fewer
    distinct_pct: int = 80  # B: fewer of its words are distinct
    capital_pct: int = 10  # C: more of its code points are capitals


def failures(limits: Limits) -> Column:
    """A to D as the bits 1, 2, 4 and 8, of ``measured`` columns."""
    fails = [
        F.col("n_words") < limits.words,
        100 * F.col("n_distinct") < limits.distinct_pct * F.col("n_words"),
        100 * F.col("n_capitals") > limits.capital_pct * F.col("n_chars"),
        F.col("n_symbols") > 0,
    ]
    bits = [F.when(fail, F.lit(1 << i)).otherwise(0) for i, fail in enumerate(fails)]
    return sum(bits[1:], bits[0])


def failure_sets(rows: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic`` of rows ``id, part, mask, digest, good, toxic``, with E as the bit 16.

    A text that very many rows share is added up before each shuffle. A null id is not smaller than any, nor any smaller than it.
    """
    same = ["digest", "part", "mask", "good", "toxic"]
    ids = rows.groupBy("id", *same).agg(F.count("*").alias("n"))
    known = F.col("id").isNotNull()
    texts = ids.groupBy(*same).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("known"),
        F.min(F.when(known, F.struct("id", "n"))).alias("first"),
    )
    first = F.min("first.id").over(Window.partitionBy("digest"))
    copies = F.col("known") - F.when(F.col("first.id") == first, F.col("first.n")).otherwise(0)
    split = F.array(
        F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(16)).alias("mask"), F.col("copies").alias("n")),
    )
    sets = texts.withColumn("copies", copies).select("part", "good", "toxic", F.inline(split)).where("n > 0")
    labelled = [F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(c) for c in ("good", "toxic")]
    return sets.groupBy("part", "mask").agg(F.sum("n").alias("n"), *labelled)


def all_orders() -> list[dict]:
    """Every step of every order: its filter's bit and the bits of the filters before it."""
    steps = []
    for order in map("".join, itertools.permutations(FILTERS)):
        bits = [1 << FILTERS.index(f) for f in order]
        steps += [{"filter_order": order, "step": i + 1, "bit": bit, "before": sum(bits[:i])} for i, bit in enumerate(bits)]
    return steps


def audit_filters(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    part_col: str = "lang",
    text_col: str = "text",
    limits: Limits = Limits(),
) -> DataFrame:
    """``part, filter_order, step`` and counts: 600 rows per part.

    ``kept`` after the step, ``removed`` by it, ``redundant``: fails its filter but went before, ``unique_fails``: fails no other filter,
    ``good_lost`` and ``toxic_lost``: removed with ``quality`` or ``toxic`` 1 in ``labels`` (``doc_id, quality, toxic``), and ``shapley``:
    what its filter removes, summed over all orders. Null texts are empty, null parts the part ''; each row counts, repeated
    ids or not; for null ids see ``failure_sets``. Of several labels of an id any 1 counts; rows without one are neither good
    nor toxic. Other columns are not looked at. An empty table gives no rows.
    """
    text, part = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, part_col))
    rows = measured(df.select(F.col(id_col).alias("id"), part.alias("part"), text.alias("text")))
    rows = rows.select("id", "part", failures(limits).alias("mask"), "digest")
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    sets = failure_sets(rows.join(marks, "id", "left").fillna(False, ["good", "toxic"]))

    steps = F.from_json(F.lit(json.dumps(all_orders())), "array<struct<filter_order: string, step: int, bit: int, before: int>>")
    met = sets.select("*", F.inline(steps))
    fails, early = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    # of all orders, the share in which this filter is the first of those that a text fails
    turns = F.lit(len(all_orders()) // len(FILTERS)) / F.bit_count("mask")

    def total(condition: Column, column: Column | str = "n") -> Column:
        return F.sum(F.when(condition, column if isinstance(column, Column) else F.col(column)).otherwise(0)).cast("long")

    return met.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~early).alias("kept"),
        total(fails & ~early).alias("removed"),
        total(fails & early).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~early, "good").alias("good_lost"),
        total(fails & ~early, "toxic").alias("toxic_lost"),
        total(fails, F.col("n") * turns.cast("long")).alias("shapley"),
    )
