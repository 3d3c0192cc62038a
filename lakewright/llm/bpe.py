"""Byte-level BPE encoding by longest matches and backtracking, and decoding.

The bytes of a piece of text are mapped to Latin-1, so that an Aho-Corasick automaton over the vocabulary
finds in one pass the longest token that starts at each byte. The encoder goes left to right, takes
the longest token that may follow the one before, falls back to shorter prefixes and, when
none is left, steps back and marks the position as dead. Two tokens may follow each other if
merging their joined bytes gives just these two: if, while merges build both, none joins the end of the one
with the start of the other. That is worked out once per pair and remembered. A
sequence in which all neighbours are so compatible is the one that the merges produce, and each
position dies at most once, so the work is linear in the length.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewright.llm.rows import Memo, in_worker
from lakewright.llm.words import PartEncoder

NEVER = 1 << 62  # above every rank
PAIRS = 500_000  # pairs of tokens a worker remembers in each generation


def load_ranks(path: str) -> dict[bytes, int]:
    """Token to rank from a file of base64 tokens and ranks, one a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairCodec:
    """Encodes and decodes by the ranks of a vocabulary: the pair whose joined bytes have the lowest rank merges first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.pairs = Memo(PAIRS)
        self.matcher = ahocorasick.Automaton()
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}  # what a token was last merged from
        self.reachable = set()  # tokens that come out of merges at all
        for token, rank in ranks.items():
            if len(token) > 1:
                halves = self.merged(token, 2)
                if len(halves) != 2:
                    continue
                self.halves[token] = tuple(halves)
            self.matcher.add_word(token.decode("latin-1"), rank)
            self.reachable.add(token)
        self.matcher.make_automaton()
        top = max(ranks.values(), default=0) + 1
        self.size, self.shorter = [0] * top, [-1] * top  # by rank: bytes; the longest proper prefix that is a token
        for token in self.reachable:
            cut = next((n for n in range(len(token) - 1, 0, -1) if token[:n] in self.reachable), 0)
            self.size[ranks[token]] = len(token)
            self.shorter[ranks[token]] = ranks[token[:cut]] if cut else -1
        self.edges = ({}, {})  # rank to growth at the left and at the right end, filled as asked for

    def merged(self, piece: bytes, until: int = 1) -> list[bytes]:
        """The plain merges of a short byte string, lowest rank first and leftmost among equals, down to ``until`` parts."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > until:
            rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def growth(self, rank: int, side: int) -> list[tuple[bytes, int]]:
        """The part at one end of a token as merges build it: from its outermost byte to the whole, with the rank at which each ends.

        A merge cannot happen before those that made its parts, hence the running maximum.
        """
        known = self.edges[side].get(rank)
        if known is None:
            parts = [self.token[rank]]
            while parts[-1] in self.halves:
                parts.append(self.halves[parts[-1]][side and 1])
            parts.reverse()
            known, ready = [], 0
            for part, whole in zip(parts, parts[1:]):
                ready = max(ready, self.ranks[whole])
                known.append((part, ready))
            known.append((parts[-1], NEVER))
            self.edges[side][rank] = known
        return known

    def crossed(self, left: int, right: int) -> bool:
        """Whether some merge joins the end of one token with the start of the next while both are being built."""
        ends, starts, i, j = self.growth(left, 1), self.growth(right, 0), 0, 0
        while True:
            (end, end_grows), (start, start_grows) = ends[i], starts[j]
            rank = self.ranks.get(end + start, NEVER)
            # at equal ranks the merge further left comes first
            if rank < end_grows and rank <= start_grows and rank != NEVER:
                return True
            if end_grows == start_grows == NEVER:
                return False
            if end_grows <= start_grows:
                i += 1
            else:
                j += 1

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens gives the two tokens."""
        key = left << 32 | right
        known = self.pairs.young.get(key)
        if known is None:
            known = self.pairs.recall(key)
            if known is None:
                known = not self.crossed(left, right)
                self.pairs.put(key, known)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """The tokens of one match of the pattern; a piece that is a token as a whole is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, shorter, known = self.size, self.shorter, self.pairs.young
        longest = [-1] * (len(piece) + 1)
        for end, rank in self.matcher.iter(piece.decode("latin-1")):
            longest[end + 1 - size[rank]] = rank  # a later end is a longer token
        alive, tokens, at, last, candidate = bytearray(b"\x01") * len(longest), [], 0, -1, longest[0]
        while at < len(piece):
            while candidate >= 0:
                end = at + size[candidate]
                if alive[end]:
                    if last < 0:
                        break
                    fits = known.get(last << 32 | candidate)
                    if fits is None:
                        fits = self.compatible(last, candidate)
                    if fits:
                        break
                candidate = shorter[candidate]
            if candidate >= 0:
                tokens.append(candidate)
                last, at = candidate, end
                candidate = longest[at]
            else:
                if not tokens:
                    raise ValueError("the vocabulary lacks a byte of the text")
                alive[at] = 0
                candidate = tokens.pop()
                at -= size[candidate]
                last = tokens[-1] if tokens else -1
        return tokens

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of texts, each cut by the pattern."""
        for text in texts:
            ids = []
            for piece in self.find(text):
                ids += self.encode_piece(piece.encode("utf-8"))
            yield array("I", ids).tobytes()

    def decode(self, ids) -> bytes:
        return b"".join([self.token[i] for i in ids])


def _codec(ranks_path: str, pattern: str) -> tuple[BytePairCodec, PartEncoder, dict[int, str]]:
    codec = BytePairCodec(load_ranks(ranks_path), pattern)
    return codec, PartEncoder(codec.encode_all), {rank: str(rank) for rank in codec.token}


def encode(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, ids``: the token ids of every row's whole text. Null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, parts, _ = in_worker(f"codec of {ranks_path} {pattern}", lambda: _codec(ranks_path, pattern))
        for batch in batches:
            ids = [np.frombuffer(parts.ids(text.as_py() or ""), "<i4") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(df: DataFrame, ranks_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, bytes`` of token ids; null counts as none. The bytes are text only if the ids came from one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = in_worker(f"tokens of {ranks_path}", lambda: {r: t for t, r in load_ranks(ranks_path).items()})
        for batch in batches:
            texts = [b"".join([token[i] for i in ids.as_py() or ()]) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.binary())], names=["id", "bytes"])

    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, bytes binary")


def round_trip(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` per row: the encoding and what decoding its ids gives, as digests.

    Null and empty texts have 0 tokens and the digests of nothing. Every row is handled by itself, so
    repeated rows, null ids and empty tables need no rule; one pass without any shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, parts, decimal = in_worker(f"codec of {ranks_path} {pattern}", lambda: _codec(ranks_path, pattern))
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for text in batch.column("text"):
                ids = array("I", parts.ids(text.as_py() or "")).tolist()
                counts.append(len(ids))
                encoded.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema)
