"""Packing by powers of two: documents are cut into pieces of binary lengths, and equal lengths go together.

A document of n tokens gives ``n // longest`` pieces of the longest length and one piece for each bit of
the rest, longest first. Every piece is a sequence of its own, so none crosses documents and none
needs padding; sequences of one length have consecutive numbers and make up batches of that length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.rows import in_worker, keyed, lean, number_rows
from lakewright.llm.words import PartEncoder

LONGEST = 2048
END_ID = 1  # follows the last token of every document


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """The lengths that ``n`` tokens are cut into, longest first."""
    bits = [1 << k for k in range(longest.bit_length() - 2, -1, -1) if (n % longest) >> k & 1]
    return [longest] * (n // longest) + bits


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


LONG_TEXT = 1 << 20  # characters beyond which a text is encoded piece by piece
BLANK = re.compile(r"(?<=\S) ")  # a byte-level tokenizer's pattern always begins a new match there


def stretches(text: str, most: int = LONG_TEXT) -> Iterator[str]:
    """A text in pieces of about ``most`` characters, each cut before a blank that follows a character other than white space."""
    at = 0
    while len(text) - at > most and (blank := BLANK.search(text, at + most)):
        yield text[at : blank.start()]
        at = blank.start()
    yield text[at:]


class FileTokenizer:
    """The tokenizer of a file with this content, built when it is first needed."""

    def __init__(self, content: str) -> None:
        self.content, self.built = content, None

    def ids(self, text: str) -> bytes:
        if self.built is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            self.built = Tokenizer.from_str(self.content)
        return array("I", self.built.encode(text, add_special_tokens=False).ids).tobytes()


class PatternEncoder:
    """Token ids of whole texts as packed little-endian 32-bit numbers, by tiktoken with the vocabulary of a tokenizer file.

    Nothing is kept between texts: a memo of parts took longer on the check tool's documents, and some 160 MB in each worker.
    """

    def __init__(self, content: str, pattern: str) -> None:
        import tiktoken

        self.by_file, model = FileTokenizer(content), json.loads(content)
        self.added = {token["content"] for token in model["added_tokens"]}
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in self.added}
        self.encode = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self.by_file.ids(text)
        return b"".join(array("I", self.encode(piece)).tobytes() for piece in stretches(text))


def encoder_of(content: str, pattern: str | None) -> PartEncoder | PatternEncoder:
    """The encoder of a tokenizer file with this content, without special tokens added.

    ``pattern`` promises that the file holds a byte-level BPE whose ids are the order of its merges, cut by that
    pattern. Its vocabulary then goes to tiktoken, which gives the same ids several times faster; only
    texts that hold an added token of the file stay with the file's own tokenizer.
    """
    if pattern is not None:
        return PatternEncoder(content, pattern)
    by_file = FileTokenizer(content)
    return PartEncoder(lambda texts: map(by_file.ids, texts))


def file_encoder(path: str, pattern: str | None) -> PartEncoder | PatternEncoder:
    """``encoder_of`` a file's content."""
    with open(path, encoding="utf-8") as file:
        return encoder_of(file.read(), pattern)


def cut_documents(
    rows: DataFrame, tokenizer_path: str, pattern: str | None, longest: int, with_ids: bool
) -> DataFrame:
    """``rid, id, start, length, ids_crc32, doc_tokens`` of every piece of ``keyed`` rows, and its ``ids`` on demand."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = in_worker(f"encoder of {tokenizer_path} {pattern}", lambda: file_encoder(tokenizer_path, pattern))
        for batch in batches:
            rows_of, starts, lengths, sums, totals, pieces = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                ids = memoryview(encoder.ids(text.as_py()) + END_ID.to_bytes(4, "little"))
                at, n = 0, len(ids) // 4
                for length in piece_lengths(n, longest):
                    piece = ids[4 * at : 4 * (at + length)]
                    rows_of.append(row)
                    starts.append(at)
                    lengths.append(length)
                    sums.append(zlib.crc32(piece))
                    totals.append(n)
                    if with_ids:
                        pieces.append(np.frombuffer(piece, "<u4").astype(np.int32))
                    at += length
            of = pa.array(rows_of, pa.int64())
            columns = [batch.column("rid").take(of), batch.column("id").take(of)]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]
            names = ["rid", "id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns, names = [*columns, pa.array(pieces, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"rid long, id {rows.schema['id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"
    return rows.select("rid", "id", "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)


def pack(
    df: DataFrame,
    tokenizer_path: str,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = LONGEST,
    with_ids: bool = False,
) -> DataFrame:
    """``id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece, and its token ``ids`` if wanted.

    ``longest`` must be a power of two; for ``pattern`` see ``file_encoder``. Sequences count from 0 without gaps, longest first, and each holds
    one piece at offset 0. Null and empty texts consist of the end id alone: one piece of length 1.
    Rows with equal or null ids are documents of their own. An empty table gives no rows.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    pieces = cut_documents(keyed(df, id_col, text_col), tokenizer_path, pattern, longest, with_ids)
    numbered, _ = number_rows(pieces, F.desc("length"), "rid", "start")
    columns = ["id", "start", "length", "ids_crc32", "doc_tokens", F.col("row_no").alias("sequence_id")]
    return numbered.select(*columns, F.lit(0).cast("long").alias("offset"), *["ids"] * with_ids)
