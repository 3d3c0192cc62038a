"""Protobuf records as typed rows.

The table schema comes from a compiled ``FileDescriptorSet``. Decoding is one
``mapInArrow`` stage: each task splits its objects into records, parses a bounded
batch of them and transposes it field by field into Arrow columns.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
from google.protobuf.descriptor import Descriptor, FieldDescriptor
from google.protobuf.message import DecodeError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from lakewright.functions.epoch import MILLIS_PER_DAY
from lakewright.sources.framing import BATCH_BYTES, BATCH_ROWS, MAX_FRAME_BYTES, object_columns, read_records, records
from lakewright.sources.stores import store_settings

# Table type of each protobuf scalar.
_SCALARS = {
    FieldDescriptor.CPPTYPE_INT32: T.IntegerType(),
    FieldDescriptor.CPPTYPE_INT64: T.LongType(),
    FieldDescriptor.CPPTYPE_UINT32: T.LongType(),
    FieldDescriptor.CPPTYPE_UINT64: T.DecimalType(23, 0),
    FieldDescriptor.CPPTYPE_FLOAT: T.FloatType(),
    FieldDescriptor.CPPTYPE_DOUBLE: T.DoubleType(),
    FieldDescriptor.CPPTYPE_BOOL: T.BooleanType(),
    FieldDescriptor.CPPTYPE_ENUM: T.StringType(),
}
_INTEGRAL = {
    FieldDescriptor.CPPTYPE_INT32,
    FieldDescriptor.CPPTYPE_INT64,
    FieldDescriptor.CPPTYPE_UINT32,
    FieldDescriptor.CPPTYPE_UINT64,
}

_SPREAD_BYTES = 16 * 1024 * 1024  # uncompressed piece of a large object that one task parses


@dataclass(frozen=True)
class MessageFormat:
    """How to read one family of objects.

    ``missing="default"`` writes an unset field as its type's default: empty text,
    zero, false, empty bytes, a struct of defaults; an enum that is unset, or zero
    without presence, as empty text. ``missing="null"`` writes a field that tracks
    presence and is unset as null, and an enum always by name.

    ``date_field`` is a dotted path to an integer epoch; divided by ``date_divisor``
    it gives the ``date`` column. Where it leads nowhere the day is 0 with
    ``bad_date="epoch"``, or the record is rejected with ``bad_date="reject"``.
    """

    descriptor_set: bytes
    message: str
    date_field: str | None = None
    date_divisor: int = MILLIS_PER_DAY
    missing: str = "default"
    bad_date: str = "epoch"
    max_frame_bytes: int = MAX_FRAME_BYTES
    batch_bytes: int = BATCH_BYTES

    def __post_init__(self):
        if self.missing not in ("default", "null"):
            raise ValueError("missing must be 'default' or 'null'")
        if self.bad_date not in ("epoch", "reject"):
            raise ValueError("bad_date must be 'epoch' or 'reject'")

    def descriptor(self) -> Descriptor:
        files = descriptor_pb2.FileDescriptorSet.FromString(self.descriptor_set).file
        pool = descriptor_pool.DescriptorPool()
        for file in files:
            pool.Add(file)
        if "." in self.message:
            return pool.FindMessageTypeByName(self.message)
        full = [
            f"{f.package}.{m.name}".lstrip(".") for f in files for m in f.message_type if m.name == self.message
        ]
        if len(full) != 1:
            raise ValueError(f"message {self.message!r}: found {full or 'none'} in the descriptor set")
        return pool.FindMessageTypeByName(full[0])

    def schema(self) -> T.StructType:
        """Columns of the decoded table: the message's fields, ``date`` if wanted, ``file``."""
        schema = message_schema(self.descriptor())
        added = {"file", "error"} | ({"date"} if self.date_field is not None else set())
        if added & set(schema.fieldNames()):
            raise ValueError(f"fields {sorted(added & set(schema.fieldNames()))} of {self.message} clash with added columns")
        if self.date_field is not None:
            schema = schema.add("date", T.DateType())
        return schema.add("file", T.StringType())


def _is_map(field: FieldDescriptor) -> bool:
    kind = field.message_type
    return kind is not None and kind.GetOptions().map_entry


def _value_type(field: FieldDescriptor, inside: tuple[str, ...]) -> T.DataType:
    if field.cpp_type == FieldDescriptor.CPPTYPE_STRING:
        return T.BinaryType() if field.type == FieldDescriptor.TYPE_BYTES else T.StringType()
    if field.cpp_type == FieldDescriptor.CPPTYPE_MESSAGE:
        return message_schema(field.message_type, inside)
    return _SCALARS[field.cpp_type]


def _field_type(field: FieldDescriptor, inside: tuple[str, ...]) -> T.DataType:
    if _is_map(field):
        key, value = (field.message_type.fields_by_name[n] for n in ("key", "value"))
        return T.MapType(_value_type(key, inside), _value_type(value, inside), True)
    kind = _value_type(field, inside)
    return T.ArrayType(kind, True) if field.is_repeated else kind


def message_schema(descriptor: Descriptor, inside: tuple[str, ...] = ()) -> T.StructType:
    """Struct type of a message; all fields nullable."""
    if descriptor.full_name in inside:
        raise ValueError(f"message {descriptor.full_name} contains itself and has no table schema")
    inside = (*inside, descriptor.full_name)
    return T.StructType([T.StructField(f.name, _field_type(f, inside), True) for f in descriptor.fields])


def _lists(lengths: Iterator[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(np.fromiter(lengths, dtype=np.int64))]).astype(np.int32))


def _values(field: FieldDescriptor, values: Sequence, kind: pa.DataType, missing: str, unset=None) -> pa.Array:
    """Arrow array of one field's values; ``unset`` marks the singular ones not set."""
    null = unset if missing == "null" else None
    if field.cpp_type == FieldDescriptor.CPPTYPE_MESSAGE:
        children = _columns(field.message_type, values, kind, missing)
        mask = None if null is None else pa.array(null, pa.bool_())
        return pa.StructArray.from_arrays(children, fields=list(kind), mask=mask)
    mask = None if null is None else np.asarray(null, dtype=bool)
    if field.cpp_type == FieldDescriptor.CPPTYPE_ENUM:
        names = {number: v.name for number, v in field.enum_type.values_by_number.items()}
        values = [names.get(v) or str(v) for v in values]
        if missing == "default" and unset is not None:
            values = ["" if gone else v for v, gone in zip(values, unset)]
    elif field.cpp_type == FieldDescriptor.CPPTYPE_UINT64:
        return pa.array(values, pa.uint64(), mask=mask).cast(kind)
    return pa.array(values, kind, mask=mask)


def _columns(descriptor: Descriptor, messages: Sequence, kind: pa.DataType, missing: str) -> list[pa.Array]:
    """One Arrow array per field, for messages of one type."""
    out = []
    for index, field in enumerate(descriptor.fields):
        name, want = field.name, kind.field(index).type
        got = [getattr(m, name) for m in messages]
        if _is_map(field):
            key, value = (field.message_type.fields_by_name[n] for n in ("key", "value"))
            items = [kv for m in got for kv in m.items()]
            keys = _values(key, [k for k, _ in items], want.key_type, missing)
            vals = _values(value, [v for _, v in items], want.item_type, missing)
            out.append(pa.MapArray.from_arrays(_lists(map(len, got)), keys, vals, type=want))
        elif field.is_repeated:
            flat = list(itertools.chain.from_iterable(got))
            values = _values(field, flat, want.value_type, missing)
            out.append(pa.ListArray.from_arrays(_lists(map(len, got)), values, type=want))
        else:
            unset, is_enum = None, field.cpp_type == FieldDescriptor.CPPTYPE_ENUM
            if field.has_presence and (missing == "null" or is_enum):
                unset = [not m.HasField(name) for m in messages]
            elif is_enum and missing == "default":
                unset = [v == 0 for v in got]
            out.append(_values(field, got, want, missing, unset))
    return out


def _epochs(descriptor: Descriptor, messages: Sequence, path: str) -> list[int] | None:
    """Value of a dotted path in each message; None if the path leads to no single integer."""
    steps = path.split(".")
    for step in steps[:-1]:
        field = descriptor.fields_by_name.get(step)
        if field is None or field.is_repeated or field.message_type is None:
            return None
        messages = [getattr(m, step) for m in messages]
        descriptor = field.message_type
    field = descriptor.fields_by_name.get(steps[-1])
    if field is None or field.is_repeated or field.cpp_type not in _INTEGRAL:
        return None
    return [getattr(m, steps[-1]) for m in messages]


_REJECT_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("record", T.BinaryType()),
    ]
)


#: What a row of ``decode_all`` is, and what is known of it beside the message.
KIND, ABOUT = "row_kind", "about"
RECORD, REJECT, OBJECT = "record", "reject", "object"
ABOUT_SCHEMA = T.StructType([*_REJECT_SCHEMA.fields[1:], T.StructField("frames", T.LongType())])


class _Decoder:
    """Parses and dates the records of one task, in bounded batches."""

    def __init__(self, fmt: MessageFormat):
        self.fmt = fmt
        self.descriptor = fmt.descriptor()
        self.parse = message_factory.GetMessageClass(self.descriptor).FromString

    def _days(self, messages: list) -> list[int | str]:
        epochs = _epochs(self.descriptor, messages, self.fmt.date_field)
        missing = "date field is missing" if self.fmt.bad_date == "reject" else 0
        if epochs is None:
            return [missing] * len(messages)
        days = (e // self.fmt.date_divisor if e else missing for e in epochs)
        return [d if isinstance(d, str) or abs(d) < 2**31 else "date is out of range" for d in days]

    def batches(self, rows: Iterator[tuple[str, int, bytes | None, str | None]]) -> Iterator[tuple[tuple, list, list]]:
        """``(accepted, rejected, finished)`` of (file, offset, record, error) rows.

        Accepted are lists of files, messages and days; rejected rows are (file, offset, error, record), finished objects
        (file, frames).
        """
        parsed: tuple = ([], [], [], [])
        rejected: list[tuple] = []
        finished: list[tuple] = []
        size = 0
        for path, offset, record, error in rows:
            if record is None:
                if error is None:
                    finished.append((path, offset))
                else:
                    rejected.append((path, offset, error, None))
                continue
            try:
                message = self.parse(record)
            except DecodeError as err:
                rejected.append((path, offset, f"not a {self.descriptor.name}: {err}", record))
            else:
                for column, value in zip(parsed, (path, message, offset, record)):
                    column.append(value)
            size += len(record)
            if size >= self.fmt.batch_bytes or len(parsed[0]) + len(rejected) >= BATCH_ROWS:
                yield *self._dated(parsed, rejected), finished
                parsed, rejected, finished, size = ([], [], [], []), [], [], 0
        if parsed[0] or rejected or finished:
            yield *self._dated(parsed, rejected), finished

    def _dated(self, parsed: tuple, rejected: list) -> tuple[tuple, list]:
        files, messages, offsets, records = parsed
        if self.fmt.date_field is None:
            return (files, messages, None), rejected
        days = self._days(messages)
        bad = [i for i, day in enumerate(days) if isinstance(day, str)]
        if bad:
            rejected += [(files[i], offsets[i], days[i], records[i]) for i in bad]
            good = [i for i, day in enumerate(days) if not isinstance(day, str)]
            files, messages, days = ([column[i] for i in good] for column in (files, messages, days))
        return (files, messages, days), rejected


def _decode(df: DataFrame, fmt: MessageFormat, rows_of: Callable, whole: bool = False) -> DataFrame:
    """Rows of the message's columns and ``error``; if ``whole``, of all three kinds with ``about`` and ``row_kind``."""
    schema = fmt.schema()
    more = [T.StructField(ABOUT, ABOUT_SCHEMA), T.StructField(KIND, T.StringType())]
    if whole and {f.name for f in more} & set(schema.fieldNames()):
        raise ValueError(f"fields named {KIND} or {ABOUT} clash with columns of the table")
    full = T.StructType(schema.fields + (more if whole else [T.StructField("error", T.StringType())]))
    arrow = to_arrow_schema(full)
    n = len(schema.fields)
    body = pa.struct([arrow.field(i) for i in range(n - (2 if fmt.date_field is not None else 1))])
    about = to_arrow_schema(ABOUT_SCHEMA)

    def tail(kind: str, rows: int, columns: dict[str, list]) -> list[pa.Array]:
        """What follows the file's column, given the known columns of ``about`` or none for a record."""
        if not whole:
            return [pa.array(columns.get("error", [None] * rows), pa.string())]
        known = [pa.array(columns.get(f.name, [None] * rows), f.type) for f in about]
        struct = pa.StructArray.from_arrays(known, fields=list(about), mask=pa.array([not columns] * rows))
        return [struct, pa.array([kind] * rows, pa.string())]

    def bare(files: list, kind: str, columns: dict[str, list]) -> pa.RecordBatch:
        """Rows without a message."""
        nulls = [pa.nulls(len(files), f.type) for f in arrow][: n - 1]
        return pa.RecordBatch.from_arrays([*nulls, pa.array(files, pa.string()), *tail(kind, len(files), columns)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _Decoder(fmt)
        for (files, messages, days), rejected, finished in decoder.batches(rows_of(batches)):
            if files:
                columns = _columns(decoder.descriptor, messages, body, fmt.missing)
                if days is not None:
                    columns.append(pa.array(days, pa.int32()).cast(pa.date32()))
                columns.append(pa.array(files, pa.string()))
                yield pa.RecordBatch.from_arrays([*columns, *tail(RECORD, len(files), {})], schema=arrow)
            if rejected:
                names, offsets, errors, found = map(list, zip(*rejected))
                yield bare(names, REJECT, {"offset": offsets, "error": errors, "record": found})
            if finished and whole:
                names, counts = map(list, zip(*finished))
                yield bare(names, OBJECT, {"frames": counts})

    return df.mapInArrow(run, full)


def decode_objects(df: DataFrame, fmt: MessageFormat) -> DataFrame:
    """Typed rows of the objects in ``path`` (and ``content``) rows, plus an ``error`` column.

    ``error`` is null on a good row. A rejected record becomes a row of nulls with
    its file and error, so it can be counted in the same pass; ``reject_records``
    gives its bytes.
    """
    settings = store_settings(df.sparkSession)
    return _decode(object_columns(df), fmt, lambda batches: records(batches, settings, fmt.max_frame_bytes))


def decode_all(df: DataFrame, fmt: MessageFormat, spread_above: int | None = None, tasks: int = 1) -> DataFrame:
    """Everything that one reading of the objects gives, told apart by ``row_kind``.

    ``record`` rows have the message's columns; ``reject`` rows have offset, error and bytes in ``about``; one ``object``
    row per object read to its end or break has the number of frames seen, a broken one counted too, so that frames less
    rejects are the accepted records. With ``spread_above``, the records of larger objects are parsed by ``tasks`` tasks,
    as in ``decode_spread``.
    """
    settings = store_settings(df.sparkSession)
    if spread_above is None:
        return _decode(object_columns(df), fmt, lambda batches: records(batches, settings, fmt.max_frame_bytes, True), True)
    large = read_records(df.where(F.col("length") > spread_above), fmt.max_frame_bytes, fmt.batch_bytes, True)
    spread = large.repartition(tasks, "file", F.floor(F.col("offset") / _SPREAD_BYTES))
    return decode_all(df.where(F.col("length") <= spread_above), fmt).unionByName(_decode(spread, fmt, _record_rows, True))


def _record_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def decode_records(df: DataFrame, fmt: MessageFormat) -> DataFrame:
    """The same as ``decode_objects`` from the rows of ``read_records``.

    Splitting an object into records is the light part of reading it. Done as a
    stage of its own, the records of a few large objects can be spread over many
    tasks before they are parsed.
    """

    return _decode(df.select("file", "offset", "record", "error"), fmt, _record_rows)


def decode_spread(df: DataFrame, fmt: MessageFormat, large_bytes: int, tasks: int) -> DataFrame:
    """As ``decode_objects``, with the records of objects above ``large_bytes`` spread over ``tasks``.

    Needs the ``length`` column. Each branch reads the contents of its own objects only.
    """
    large = read_records(df.where(F.col("length") > large_bytes), fmt.max_frame_bytes, fmt.batch_bytes)
    runs = F.floor(F.col("offset") / _SPREAD_BYTES)  # neighbours stay together, and with them their date
    return decode_objects(df.where(F.col("length") <= large_bytes), fmt).unionByName(
        decode_records(large.repartition(tasks, "file", runs), fmt)
    )


def reject_records(df: DataFrame, fmt: MessageFormat) -> DataFrame:
    """``file, offset, error, record`` of every record that ``decode_objects`` rejects."""
    arrow, settings = to_arrow_schema(_REJECT_SCHEMA), store_settings(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rejected, _ in _Decoder(fmt).batches(records(batches, settings, fmt.max_frame_bytes)):
            if rejected:
                columns = [pa.array(c, t) for c, t in zip(zip(*rejected), arrow.types)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return object_columns(df).mapInArrow(run, _REJECT_SCHEMA)
