"""Line deduplication: explode normalised lines, hash, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.rows import keyed
from lakewright.llm.units import held_units, repeated_units

MIN_CHARS = 10
MIN_DOCS = 2


def line_key(line: bytes) -> bytes:
    """The line without ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z in lower case; other letters stay as they are."""
    return line.strip().lower()  # of bytes: ASCII only


def key_digest(line: bytes, min_chars: int) -> bytes | None:
    """The digest of a line's key, or None if the key has too few code points to count."""
    key = line_key(line)
    # a code point takes one to four bytes
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def dedup_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``id, text, n_lines, n_dropped`` per row, ``text`` being the lines that stay, joined by a line feed.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses its lines
    except in the document with the smallest id, which keeps all of them. Null and empty texts are one
    empty line. Repeated ids are documents of their own, in a fixed arbitrary order; a null id is the smallest.
    Every row comes out, also one that loses all its lines (its text is then empty). An empty table gives no rows.
    """
    rows = keyed(df, id_col, text_col)

    def digests(text: bytes) -> list[bytes]:
        found = (key_digest(line, min_chars) for line in text.split(b"\n"))
        return [d for d in found if d is not None]

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, drops = [], [], []
            for text, units in zip(batch.column("bytes"), batch.column("units")):
                lines = text.as_py().split(b"\n")
                kept = lines
                if units.is_valid:
                    gone = set(units.as_py())
                    kept = [line for line in lines if key_digest(line, min_chars) not in gone]
                texts.append(b"\n".join(kept))
                totals.append(len(lines))
                drops.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()), pa.array(drops, pa.int64())],
                names=["id", "text", "n_lines", "n_dropped"],
            )

    gone = repeated_units(held_units(rows, digests), min_docs)
    joined = rows.join(gone, "rid", "left").select("id", F.col("text").cast("binary").alias("bytes"), "units")
    id_type = joined.schema["id"].dataType.simpleString()
    return joined.mapInArrow(rebuild, f"id {id_type}, text string, n_lines long, n_dropped long")
