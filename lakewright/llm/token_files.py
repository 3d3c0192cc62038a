"""Token files: ids as equal-length sequences in Arrow's file format, read by place without a copy.

The ids of all documents, each followed by the end id, run on in ascending order of the document ids and are cut
into sequences of one length. A file is an Arrow IPC file whose batches hold three columns:

* ``ids``: a fixed-size list of the narrowest unsigned numbers that hold the vocabulary,
* ``mask``: a fixed-size list of booleans, true where an id stands and false in padding,
* ``docs``: of the documents that begin in the sequence, their id, place and number of ids.

Fixed-size lists have no offsets, and every batch but a file's last holds as many sequences, so the k-th sequence lies at a
place that is computed; a mapped file gives it as views of its own memory. Files end with a document; only their last
sequence is padded. A table beside them, which Spark commits when all are written, names the files
in order. A task that is lost or run twice leaves a file that this table does not name and nobody reads.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakewright.llm.packing import encoder_of
from lakewright.llm.rows import in_worker, keyed
from lakewright.scratch import qualified_path
from lakewright.sources.stores import store_of, store_settings

LENGTH = 2048
END_ID = 0  # follows the last token of every document
BATCH = 256  # sequences of a batch
FILE_TOKENS = 1 << 25  # a file ends with the first document that reaches so many ids

_FILES = "name string, first long, n_docs long, n_tokens long, n_sequences long"


def id_type(vocabulary: int) -> pa.DataType:
    """The narrowest unsigned type for ids below ``vocabulary``."""
    return pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()


class TokenWriter:
    """One file: takes documents in order and writes a batch whenever it is full."""

    def __init__(self, sink: pa.NativeFile, length: int, batch: int, ids: pa.DataType, key: pa.DataType) -> None:
        docs = pa.list_(pa.struct([("id", key), ("at", pa.int32()), ("n_tokens", pa.int64())]))
        self.schema = pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length)), ("docs", docs)])
        self.length, self.batch, self.dtype = length, batch, ids.to_pandas_dtype()
        self.file = pa.ipc.new_file(sink, self.schema)
        self.pending, self.n_pending, self.docs = [], 0, []  # not yet written; docs: (id, place in the file, length)
        self.n_tokens = self.n_docs = self.n_sequences = 0

    def add(self, key: Any, ids: np.ndarray) -> None:
        self.docs.append((key, self.n_tokens, len(ids)))
        self.n_docs += 1
        self.n_tokens += len(ids)
        room = self.batch * self.length
        while len(ids):
            part, ids = ids[: room - self.n_pending], ids[room - self.n_pending :]
            self.pending.append(part.astype(self.dtype))
            self.n_pending += len(part)
            if self.n_pending == room:
                self._flush()

    def close(self) -> None:
        if self.n_pending:
            self._flush()
        self.file.close()

    def _flush(self) -> None:
        n = -(-self.n_pending // self.length)
        ids = np.zeros(n * self.length, self.dtype)
        np.concatenate(self.pending, out=ids[: self.n_pending])
        begin = self.n_sequences * self.length
        sequences = [(place - begin) // self.length for _, place, _ in self.docs]
        places = pa.array([(place - begin) % self.length for _, place, _ in self.docs], pa.int32())
        kind = self.schema.field("docs").type.value_type
        docs = pa.StructArray.from_arrays(
            [pa.array([d[0] for d in self.docs], kind.field("id").type), places, pa.array([d[2] for d in self.docs], pa.int64())],
            fields=list(kind),
        )
        offsets = pa.array(np.searchsorted(sequences, np.arange(n + 1)), pa.int32())
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids), type=self.schema.field("ids").type),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < self.n_pending), type=self.schema.field("mask").type),
            pa.ListArray.from_arrays(offsets, docs, type=self.schema.field("docs").type),
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.pending, self.n_pending, self.docs, self.n_sequences = [], 0, [], self.n_sequences + n


class TokenFile:
    """Random access to the sequences of one file. ``source``: a local path, which is mapped, or an open file."""

    def __init__(self, source: str | pa.NativeFile) -> None:
        self.reader = pa.ipc.open_file(pa.memory_map(source) if isinstance(source, str) else source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.per_batch = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 0

    def __len__(self) -> int:
        last = self.reader.num_record_batches - 1
        return 0 if last < 0 else last * self.per_batch + self.reader.get_batch(last).num_rows

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of the ``k``-th sequence; both are views of the file's memory."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        batch, at = self.reader.get_batch(k // self.per_batch), k % self.per_batch * self.length
        ids, mask = (batch.column(name).values.slice(at, self.length) for name in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def documents(self) -> Iterator[tuple[Any, int, int, int]]:
        """``(id, start in the file, number of ids, CRC-32 of them as little-endian unsigned 32-bit numbers)``, a batch at a time."""
        open_doc = None  # (id, start, length, checksum so far, ids still to come)
        for k in range(self.reader.num_record_batches):
            batch, begin = self.reader.get_batch(k), k * self.per_batch * self.length
            ids = memoryview(batch.column("ids").values.to_numpy(zero_copy_only=True).astype("<u4")).cast("B")
            if open_doc:
                key, start, n, crc, left = open_doc
                take = min(left, len(ids) // 4)
                open_doc = key, start, n, zlib.crc32(ids[: 4 * take], crc), left - take
                if open_doc[-1]:
                    continue
                yield open_doc[:-1]
                open_doc = None
            docs = batch.column("docs")
            sequences = np.repeat(np.arange(len(docs)), np.diff(docs.offsets.to_numpy())) * self.length
            found = docs.flatten()
            places = (sequences + found.field("at").to_numpy()).tolist()
            for key, at, n in zip(found.field("id").to_pylist(), places, found.field("n_tokens").to_pylist()):
                here = ids[4 * at : 4 * (at + n)]
                open_doc = key, begin + at, n, zlib.crc32(here), n - len(here) // 4
                if not open_doc[-1]:
                    yield open_doc[:-1]
                    open_doc = None


def write_tokens(
    df: DataFrame,
    path: str,
    tokenizer: str,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    file_tokens: int = FILE_TOKENS,
    batch: int = BATCH,
) -> DataFrame:
    """Encode all documents into token files in the folder ``path``; the table of files, as ``token_files`` reads it.

    ``tokenizer`` is the file of a tokenizer, read on the driver and sent to the tasks once; for ``pattern`` see ``packing.encoder_of``.
    Rows are sorted by id over the cluster, and each task writes the files of its range, holding one document and one
    batch at a time. Null and empty texts give the end id alone. Rows with equal or null ids are documents of their own: nulls first,
    equal ids in a fixed but arbitrary order. Other columns of ``df`` are not looked at. An empty table gives no files.
    """
    spark = df.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    found = json.loads(content)
    ids = [*found["model"]["vocab"].values(), *(t["id"] for t in found["added_tokens"]), end_id]
    kind, sent = id_type(max(ids) + 1), spark.sparkContext.broadcast(content)
    settings = store_settings(spark)
    folder, name = qualified_path(spark, f"{path}/data"), f"encoder of {zlib.crc32(content.encode())} {pattern}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = in_worker(name, lambda: encoder_of(sent.value, pattern))
        store, where = store_of(folder, settings)
        store.create_dir(where, recursive=True)
        writer, first, of = None, None, None

        def ended() -> pa.RecordBatch:
            writer.close()
            sink.close()
            row = [[of], [first], [writer.n_docs], [writer.n_tokens], [writer.n_sequences]]
            return pa.RecordBatch.from_arrays(list(map(pa.array, row)), names=["name", "first", "n_docs", "n_tokens", "n_sequences"])

        for rows in batches:
            for rid, key, text in zip(rows.column("rid"), rows.column("id"), rows.column("text")):
                if writer is None:
                    of, first = f"{uuid.uuid4().hex}.arrow", rid.as_py()
                    sink = store.open_output_stream(f"{where}/{of}")
                    writer = TokenWriter(sink, length, batch, kind, rows.schema.field("id").type)
                ids = encoder.ids(text.as_py()) + end_id.to_bytes(4, "little")
                writer.add(key.as_py(), np.frombuffer(ids, "<u4"))
                if writer.n_tokens >= file_tokens:
                    yield ended()
                    writer = None
        if writer is not None:
            yield ended()

    rows = keyed(df, id_col, text_col).select("rid", "id", "text")
    written = rows.repartitionByRange("rid").sortWithinPartitions("rid").mapInArrow(write, _FILES)
    written.write.parquet(f"{path}/files")
    return token_files(spark, path)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """``name, start, first_sequence, n_docs, n_tokens, n_sequences`` of each file of ``path``; start: ids in the files before it.

    One row per file; only these are brought together to be summed up in order.
    """
    files = spark.read.schema(_FILES).parquet(f"{path}/files")
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    start, sequence = (F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("n_tokens", "n_sequences"))
    return files.select("name", start.alias("start"), sequence.alias("first_sequence"), "n_docs", "n_tokens", "n_sequences")


def _opened(spark: SparkSession, path: str):
    """The files of ``path`` dealt among tasks, and what opens one of them in a task."""
    folder, settings = qualified_path(spark, f"{path}/data"), store_settings(spark)

    def open_file(name: str) -> TokenFile:
        store, where = store_of(folder, settings)
        local = folder.startswith(("file:", "/"))
        return TokenFile(f"{where}/{name}" if local else store.open_input_file(f"{where}/{name}"))

    files, most = token_files(spark, path), int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(max(1, min(files.count(), most))), open_file


def read_documents(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` per document, from the files alone; start counts the ids of all documents before it.

    ``id_type`` is the SQL type of the ids that were written. A task holds one batch of a file at a time.
    """
    files, open_file = _opened(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                file, rows = open_file(name), []
                key = file.reader.schema.field("docs").type.value_type.field("id").type
                types = [key, *[pa.int64()] * 3]
                for key, at, n, crc in file.documents():
                    rows.append((key, start + at, n, crc))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    return files.select("name", "start").mapInArrow(read, f"id {id_type}, start long, n_tokens long, ids_crc32 long")


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """``sequence_id, ids, mask`` of every sequence, numbered from 0 without gaps in the order of the documents."""
    files, open_file = _opened(spark, path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column("name").to_pylist(), batch.column("first_sequence").to_pylist()):
                file = open_file(name)
                for k in range(file.reader.num_record_batches):
                    part = file.reader.get_batch(k)
                    ids = part.column("ids").cast(pa.list_(pa.int32(), file.length)).cast(pa.list_(pa.int32()))
                    mask = part.column("mask").cast(pa.list_(pa.bool_()))
                    numbers = pa.array(np.arange(part.num_rows) + first + k * file.per_batch, pa.int64())
                    yield pa.RecordBatch.from_arrays([numbers, ids, mask], names=["sequence_id", "ids", "mask"])

    return files.select("name", "first_sequence").mapInArrow(read, "sequence_id long, ids array<int>, mask array<boolean>")
