"""Substring deduplication by content-defined chunking.

A gear hash rolls over the bytes of a text: its value at a byte depends on the 16 bytes up to there alone. A
chunk ends where some of its bits are all zero, so the same passage is cut alike wherever it stands, and an
insertion moves the cuts around it only. Chunks are known by their digests. Of a passage that
several documents hold, the document with the smallest id keeps its chunks; the others lose
them, as does a document that repeats itself. A lone repeated chunk is a turn of phrase; only runs of repeated
chunks of some length are taken out, shrunk to whole words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.rows import forget_in_worker, keyed, lean, pieces
from lakewright.llm.units import held_units, repeated_units

#: A number for each byte value, from a public digest.
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=2).digest(), "little") for b in range(256)], np.uint16)
WINDOW = 16  # bytes; as many as the hash has bits


@dataclass(frozen=True)
class Settings:
    """Chunks have ``shortest`` to ``longest`` bytes, and about ``shortest + 2**bits`` on average. ``run``: bytes of repeated chunks from which they go."""

    shortest: int = 8
    longest: int = 96
    bits: int = 5
    run: int = 80


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte: the sum of the last 16 gear numbers, each shifted left by its distance."""
    hashes, width = GEAR[data], 1
    while width < WINDOW:  # a window of twice the width is this one and the one before it
        wider = hashes.copy()
        wider[width:] += hashes[:-width] << np.uint16(width)
        hashes, width = wider, 2 * width
    return hashes


def chunk_ends(text: bytes, settings: Settings) -> list[int]:
    """Where chunks end, never inside a character."""
    if not text:
        return []
    data = np.frombuffer(text, np.uint8)
    starts = (data & 0xC0) != 0x80  # first bytes of characters
    cut = gear_hashes(data) >> np.uint16(16 - settings.bits) == 0
    cut[:-1] &= starts[1:]
    ends, at = [], 0
    for end in [*(np.flatnonzero(cut) + 1).tolist(), len(text)]:
        while end - at > settings.longest:
            forced = at + settings.longest
            while not starts[forced]:
                forced -= 1
            ends.append(forced)
            at = forced
        if end - at >= settings.shortest or end == len(text) > at:
            ends.append(end)
            at = end
    return ends


def chunk_digests(text: bytes, ends: list[int]) -> list[bytes]:
    digest = xxhash.xxh3_64_digest
    return [digest(text[a:b]) for a, b in zip([0, *ends], ends)]


def whole_words(text: bytes, start: int, end: int) -> tuple[int, int]:
    """The span without the parts of words at its ends; the span itself if it holds no blank."""
    if start and not text[start - 1 : start].isspace():
        inner = next((i for i in range(start, end) if text[i : i + 1].isspace()), None)
        start = start if inner is None else inner + 1
    if end < len(text) and not text[end : end + 1].isspace():
        inner = next((i for i in range(end, start, -1) if text[i - 1 : i].isspace()), None)
        end = end if inner is None else inner
    return start, end


def repeated_spans(text: bytes, gone: set[bytes], settings: Settings) -> tuple[int, int, list[tuple[int, int]]]:
    """Chunks, repeated chunks, and the spans to take out, given the digests that an earlier document holds."""
    ends = chunk_ends(text, settings)
    seen, marked, spans, start = set(), 0, [], None
    for digest, at, end in zip(chunk_digests(text, ends), [0, *ends], ends):
        repeated = digest in gone or digest in seen
        seen.add(digest)
        marked += repeated
        if repeated and start is None:
            start = at
        if start is not None and (not repeated or end == len(text)):
            stop = end if repeated else at
            if stop - start >= settings.run:
                spans.append(whole_words(text, start, stop))
            start = None
    return len(ends), marked, [s for s in spans if s[0] < s[1]]


def _deduplicated(rows: DataFrame, carried: str, settings: Settings, min_docs: int) -> DataFrame:
    """The result for ``keyed`` rows, with one of their columns carried along."""

    def digests(text: bytes) -> list[bytes]:
        return chunk_digests(text, chunk_ends(text, settings))

    @lean
    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_in_worker()
        for batch in (piece for whole in batches for piece in pieces(whole, "bytes")):
            texts, found = [], []
            for text, units in zip(batch.column("bytes"), batch.column("units")):
                text = text.as_py()
                chunks, marked, spans = repeated_spans(text, set(units.as_py() or ()), settings)
                cuts = [0, *[x for span in spans for x in span], len(text)]
                texts.append(b"".join([text[a:b] for a, b in zip(cuts[::2], cuts[1::2])]))
                found.append((chunks, marked, len(text) - len(texts[-1]), [{"start": a, "end": b} for a, b in spans]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), span))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(carried), pa.array(texts, pa.binary()).cast(pa.string()), *columns],
                names=[carried, "text", "n_chunks", "n_repeated", "n_dropped_bytes", "spans"],
            )

    gone = repeated_units(held_units(rows, digests), min_docs)
    joined = rows.join(gone, "rid", "left").select(carried, F.col("text").cast("binary").alias("bytes"), "units")
    kind = joined.schema[carried].dataType.simpleString()
    schema = f"{carried} {kind}, text string, n_chunks long, n_repeated long, n_dropped_bytes long, spans array<struct<start: long, end: long>>"
    return joined.mapInArrow(rebuild, schema)


def dedup_substrings(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), min_docs: int = 2
) -> DataFrame:
    """``id, text, n_chunks, n_repeated, n_dropped_bytes, spans`` per row; ``text`` is what stays.

    ``spans`` are the half-open byte ranges taken out of the text. ``min_docs``: documents that must hold a chunk. Digests have
    64 bits; a run of chunks must repeat before anything goes, so that one collision takes nothing out. Null and
    empty texts have no chunks. Repeated ids are documents of their own; a null id is the smallest. Every
    row comes out, also one that loses everything. An empty table gives no rows.
    """
    return _deduplicated(keyed(df, id_col, text_col), "id", settings, min_docs)


def strip_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), min_docs: int = 2
) -> DataFrame:
    """All rows and columns of ``df``, the text being what stays; rules as in ``dedup_substrings``."""
    rows = keyed(df, id_col, text_col, whole=True).withColumn("row", F.col("row").dropFields(text_col))
    kept = _deduplicated(rows, "row", settings, min_docs)
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in df.columns])
