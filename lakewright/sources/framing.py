"""Length-prefixed records inside gzip objects."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lakewright.sources.stores import Settings, open_object, store_settings

# A frame is a 4-byte big-endian length followed by the record.
HEADER, HEADER_BYTES = ">I", 4
MAX_FRAME_BYTES = 8 * 1024 * 1024
BATCH_BYTES = 64 * 1024 * 1024
BATCH_ROWS = 4_000  # records held at once, however small

_PIECE = 64 * 1024


class FrameError(ValueError):
    """An object that cannot be read further. ``offset`` counts uncompressed bytes."""

    def __init__(self, offset: int, reason: str):
        super().__init__(reason)
        self.offset = offset


def _inflate(file: pa.NativeFile, fine_from: int | None = None) -> Iterator[bytes]:
    """Uncompressed pieces over all gzip members; raises ``zlib.error`` where the data breaks.

    From output position ``fine_from`` on, pieces are single bytes.
    """
    file.seek(0)
    member, feed, total, members = None, b"", 0, 0
    while True:
        feed = feed or file.read(_PIECE)
        if member is None:
            ended = not feed
            if members:
                feed = feed.lstrip(b"\0")  # zero padding between members
            if ended:
                return
            if not feed:
                continue
            member, members = zlib.decompressobj(wbits=31), members + 1
        elif not feed:
            raise zlib.error("gzip data ends early")
        while True:
            out = member.decompress(feed, _PIECE if fine_from is None or total < fine_from else 1)
            feed = member.unconsumed_tail
            if out:
                total += len(out)
                yield out
            if member.eof:
                feed, member = member.unused_data, None
                break
            if not out and not feed:
                break


def gunzip(file: pa.NativeFile) -> Iterator[bytes]:
    """As ``_inflate``, but yields every byte before a break.

    zlib drops the piece in which it meets an error. Only for such an object, the
    stream is read once more and that last piece is taken byte by byte.
    """
    done = 0
    try:
        for out in _inflate(file):
            done += len(out)
            yield out
        return
    except zlib.error as err:
        broken = err
    seen = 0
    try:
        for out in _inflate(file, fine_from=done):
            seen += len(out)
            if seen > done:
                yield out
    except zlib.error:
        raise broken from None


def frames(
    file: pa.NativeFile, max_frame: int = MAX_FRAME_BYTES
) -> Iterator[tuple[int, bytes | None, str | None]]:
    """``(offset, record, error)`` of each whole frame, in order; ``FrameError`` after the last one.

    A frame above the limit has an error and no record. Its bytes are dropped piece by piece, and reading goes on behind it.
    """
    buffer, start, base, skip = bytearray(), 0, 0, 0
    pieces, broken = gunzip(file), None
    while True:
        try:
            piece = next(pieces, None)
        except zlib.error as err:
            piece, broken = None, str(err)
        if piece is None:
            break
        base, buffer, start = base + start, buffer[start:], 0
        dropped = min(skip, len(piece))  # of a frame above the limit, which leaves nothing in the buffer
        base, skip = base + dropped, skip - dropped
        buffer += piece[dropped:]
        while len(buffer) - start >= HEADER_BYTES:
            (length,) = struct.unpack_from(HEADER, buffer, start)
            end = start + HEADER_BYTES + length
            if length > max_frame:
                yield base + start, None, f"frame of {length} bytes exceeds the limit of {max_frame}"
                skip, end = max(0, end - len(buffer)), min(end, len(buffer))
            elif end > len(buffer):
                break
            else:
                yield base + start, bytes(buffer[start + HEADER_BYTES : end]), None
            start = end
    if broken is not None:
        raise FrameError(base + start, broken)
    if start < len(buffer) or skip:
        raise FrameError(base + start, "object ends inside a frame")


def objects(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[tuple[str, pa.NativeFile]]:
    """``(path, stream)`` of each row: over its ``content``, not copied, or over the ``path``, opened with the store's settings."""
    for batch in batches:
        paths = batch.column("path")
        contents = batch.column("content") if "content" in batch.schema.names else None
        for i in range(batch.num_rows):
            path = paths[i].as_py()
            with open_object(path, settings) if contents is None else pa.BufferReader(contents[i].as_buffer()) as file:
                yield path, file


def object_columns(df: DataFrame) -> DataFrame:
    """The columns a reading stage needs: ``path`` and, if it is there, ``content``."""
    return df.select(*(c for c in ("path", "content") if c in df.columns))


def records(
    batches: Iterator[pa.RecordBatch], settings: Settings, max_frame: int = MAX_FRAME_BYTES, ends: bool = False
) -> Iterator[tuple[str, int, bytes | None, str | None]]:
    """``(file, offset, record, error)`` of object rows; one without a record for a frame above the limit and where an object breaks.

    With ``ends``, a row with neither record nor error follows each object; its offset is the number of rows before it.
    """
    for path, file in objects(batches, settings):
        n = 0
        try:
            for offset, record, error in frames(file, max_frame):
                n += 1
                yield path, offset, record, error
        except FrameError as err:
            n += 1
            yield path, err.offset, None, str(err)
        if ends:
            yield path, n, None, None


_RECORD_SCHEMA = "file string, offset bigint, record binary, error string"


def read_records(
    df: DataFrame, max_frame: int = MAX_FRAME_BYTES, batch_bytes: int = BATCH_BYTES, ends: bool = False
) -> DataFrame:
    """``file, offset, record, error`` of the objects in ``path`` (and ``content``) rows.

    Whole objects are the unit of work, as gzip cannot be split. A task holds one
    object and one output batch of about ``batch_bytes``; without a ``content``
    column it opens each path itself and holds a small piece of it only. A broken
    object keeps its good records and adds one row with the error and the offset. For ``ends`` see ``records``.
    """
    arrow = pa.schema(
        [("file", pa.string()), ("offset", pa.int64()), ("record", pa.binary()), ("error", pa.string())]
    )

    settings = store_settings(df.sparkSession)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows), arrow.types)), schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for row in records(batches, settings, max_frame, ends):
            rows.append(row)
            size += len(row[2] or b"")
            if size >= batch_bytes or len(rows) >= BATCH_ROWS:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return object_columns(df).mapInArrow(run, _RECORD_SCHEMA)
