import gzip
import os
import random
import struct
import zlib
from decimal import Decimal

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewright.sources.exports import frame_object
from lakewright.sources.framing import FrameError, frames, read_records
from lakewright.plans.backfill import pending_rows
from lakewright.sources.listing import list_objects, read_objects
from lakewright.sources.messages import MessageFormat, decode_objects, decode_spread, reject_records
from lakewright.sources.schema_history import SchemaConflict, evolve, record_schema
from lakewright.streaming.ingest import ingest_counts, ingest_objects, ingest_pending, read_bronze, read_ledger, read_rejects
from tests.protos import all_types, clashing, message_class

DAY = 86_400_000
T0 = 1_700_000_000_000


def drain(content, **kw):
    got, error = [], None
    try:
        for offset, record, _ in frames(pa.BufferReader(content), **kw):
            got.append((offset, record))
    except FrameError as err:
        error = err
    return got, error


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=20), st.integers(0, 20))
def test_frames_round_trip_over_members(records, cut):
    content = frame_object(records[:cut]) + frame_object(records[cut:])
    got, error = drain(content)
    assert error is None and [r for _, r in got] == records


def test_big_object_crosses_pieces():
    rnd = random.Random(1)
    records = [rnd.randbytes(rnd.randrange(0, 90_000)) for _ in range(200)]
    got, error = drain(frame_object(records))
    assert error is None and [r for _, r in got] == records


def test_truncated_object_keeps_good_prefix():
    rnd = random.Random(2)
    records = [rnd.randbytes(100) for _ in range(2000)]
    content = frame_object(records)
    got, error = drain(content[: len(content) // 2])
    assert error is not None and 900 < len(got) < 1000
    assert [r for _, r in got] == records[: len(got)]
    assert error.offset == len(got) * 104


def test_corrupt_byte_keeps_records_before_it():
    records = [struct.pack(">I", i) * 5 for i in range(5000)]
    content = bytearray(frame_object(records))
    middle = len(content) // 2
    content[middle : middle + 40] = b"\xff" * 40
    got, error = drain(bytes(content))
    assert error is not None and got[:1000] == [(i * 24, r) for i, r in enumerate(records[:1000])]
    # every whole frame among the bytes zlib can inflate is kept
    d, plain = zlib.decompressobj(31), b""
    with pytest.raises(zlib.error):
        for b in bytes(content):
            plain += d.decompress(bytes([b]))
    assert got == drain(gzip.compress(plain))[0]


def test_oversize_frame_costs_only_itself():
    rnd = random.Random(3)
    big, huge = rnd.randbytes(100), rnd.randbytes(1_000_000)  # one within a piece, one over many
    content = frame_object([b"a" * 10, big, b"c", huge, huge, b"d", big])
    rows = list(frames(pa.BufferReader(content), max_frame=50))
    assert [r for _, r, _ in rows] == [b"a" * 10, None, b"c", None, None, b"d", None]
    assert [o for o, _, _ in rows] == [0, 14, 118, 123, 1_000_127, 2_000_131, 2_000_136]
    assert [e for *_, e in rows if e][1] == "frame of 1000000 bytes exceeds the limit of 50"
    whole = struct.pack(">I", 10) + b"a" * 10 + struct.pack(">I", 1000) + b"b" * 999
    got, error = drain(gzip.compress(whole), max_frame=50)
    assert got == [(0, b"a" * 10), (14, None)] and "ends inside" in str(error)


def test_empty_and_padded():
    assert drain(b"") == ([], None)
    assert drain(frame_object([])) == ([], None)
    got, error = drain(frame_object([b"x"]) + b"\0\0\0" + frame_object([b"y"]))
    assert error is None and [r for _, r in got] == [b"x", b"y"]


def write(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(records if isinstance(records, bytes) else frame_object(records))


def sample(cls, i):
    m = cls(i32=-i, i64=-(2**40) - i, u32=2**32 - 1 - i, u64=2**64 - 1 - i, f32=0.5, f64=i / 7, flag=i % 2 == 0)
    m.txt, m.raw, m.col = f"t{i}", bytes([i, 0]), i % 3
    m.sub.tag = f"s{i}"
    m.sub.nums.extend(range(i))
    m.nums.extend([2**64 - 1, i])
    for k in range(i % 3):
        m.subs.add(tag=f"r{k}").nums.extend([k, k + 1])
    m.counts[f"k{i}"] = i
    m.cols.extend([1, 2, 9])
    return m


def test_schema_of_all_types():
    schema = MessageFormat(all_types(), "all_types", date_field="i64").schema()
    inner = "struct<tag:string,nums:array<bigint>>"
    assert schema.simpleString() == (
        "struct<i32:int,i64:bigint,u32:bigint,u64:decimal(23,0),f32:float,f64:double,flag:boolean,"
        f"txt:string,raw:binary,col:string,sub:{inner},nums:array<decimal(23,0)>,subs:array<{inner}>,"
        "counts:map<string,bigint>,cols:array<string>,date:date,file:string>"
    )


def test_decode_all_types(spark, tmp_path):
    cls = message_class(all_types(), "all_types")
    src = str(tmp_path / "src")
    write(src, f"all.{T0}.gz", [sample(cls, i).SerializeToString() for i in range(10)])
    rows = decode_objects(
        read_objects(spark, src), MessageFormat(all_types(), "all_types", date_field="sub.tag")
    ).orderBy(F.desc("i32")).collect()
    assert len(rows) == 10 and all(r.error is None for r in rows)
    for i, r in enumerate(rows):
        assert (r.i32, r.i64, r.u32, r.u64) == (-i, -(2**40) - i, 2**32 - 1 - i, Decimal(2**64 - 1 - i))
        assert (r.f32, r.f64, r.flag, r.txt, bytes(r.raw)) == (0.5, i / 7, i % 2 == 0, f"t{i}", bytes([i, 0]))
        assert r.col == ["", "red", "blue"][i % 3]
        assert r["sub"].tag == f"s{i}" and r["sub"].nums == list(range(i))
        assert r.nums == [Decimal(2**64 - 1), Decimal(i)]
        assert [(s.tag, s.nums) for s in r.subs] == [(f"r{k}", [k, k + 1]) for k in range(i % 3)]
        assert r.counts == {f"k{i}": i} and r.cols == ["red", "blue", "9"]
        assert str(r.date) == "1970-01-01" and r.file.endswith(f"all.{T0}.gz")


def test_missing_policies(spark, tmp_path):
    src = str(tmp_path / "src")
    write(src, f"all.{T0}.gz", [b""])
    df = read_objects(spark, src)
    row = decode_objects(df, MessageFormat(all_types(), "all_types")).first()
    assert (row.i32, row.txt, bytes(row.raw), row.col, row.flag, row.u64) == (0, "", b"", "", False, 0)
    assert (row["sub"].tag, row["sub"].nums, row.subs, row.counts) == ("", [], [], {})
    row = decode_objects(df, MessageFormat(all_types(), "all_types", missing="null")).first()
    assert row["sub"] is None and row.col == "none" and row.i32 == 0


def test_bad_dates(spark, tmp_path):
    cls = message_class(all_types(), "all_types")
    src = str(tmp_path / "src")
    records = [cls(u64=T0), cls(), cls(u64=2**64 - 1)]
    write(src, f"all.{T0}.gz", [m.SerializeToString() for m in records])
    df = read_objects(spark, src)
    fmt = MessageFormat(all_types(), "all_types", date_field="u64", date_divisor=1000)
    rows = decode_objects(df, fmt).select("u64", F.col("date").cast("string").alias("d"), "error").collect()
    by = {(None if r.u64 is None else int(r.u64)): r for r in rows}
    assert by[0].d == "1970-01-01" and by[T0].error is None
    assert by[None].error == "date is out of range" and len(rows) == 3
    strict = MessageFormat(all_types(), "all_types", date_field="nowhere.at", bad_date="reject")
    assert {r.error for r in decode_objects(df, strict).collect()} == {"date field is missing"}
    assert reject_records(df, strict).count() == 3


def test_read_records_frame(spark, tmp_path):
    src = str(tmp_path / "src")
    write(src, f"a.{T0}.gz", [b"1", b"22"])
    content = frame_object([b"3" * 50, b"4" * 50])
    write(src, f"a.{T0 + 1}.gz", content[: len(content) - 9])
    write(src, "notes.txt", b"ignored")
    rows = read_records(read_objects(spark, src), batch_bytes=1).orderBy("file", "offset").collect()
    assert [bytes(r.record) if r.record is not None else None for r in rows][:2] == [b"1", b"22"]
    assert [r.offset for r in rows][:2] == [0, 5]
    assert rows[-1].error is not None and rows[-1].record is None


def test_stream_ingest_end_to_end(spark, tmp_path):
    cls = message_class(all_types(), "all_types")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    fmt = MessageFormat(all_types(), "all_types", date_field="u64")

    def record(i, day):
        return cls(i32=i, u64=T0 + day * DAY).SerializeToString()

    for day in range(1, 5):
        write(src, f"all.{T0 + day * DAY}.gz", [record(day * 10 + k, day) for k in range(3)])
    write(src, f"other.{T0}.gz", [record(999, 0)])
    write(src, f"all.{T0 + 6 * DAY}.gz", [record(60, 6), b"\xff\xff", record(61, 6)])
    whole = frame_object([record(70 + i, 7) for i in range(500)])
    write(src, f"all.{T0 + 7 * DAY}.gz", whole[: len(whole) // 2])

    record_schema(spark, out, fmt.schema())
    assert read_bronze(spark, out).count() == 0  # known before the first batch

    def run():
        q = ingest_objects(spark, src, out, ck, fmt, prefix="all", max_bytes_per_trigger=150)
        q.awaitTermination()
        return q

    q = run()
    assert len(q.recentProgress) >= 3  # several bounded micro-batches
    first = read_bronze(spark, out)
    n = first.count()
    assert ingest_counts(spark, out) == {"accepted": n, "rejected": 2}
    assert first.where("i32 < 70").count() == 14 and 100 < n < 500
    assert dict(first.dtypes)["date"] == "date" and first.where("i32 = 999").count() == 0
    assert str(first.where("i32 = 11").first().date) == "2023-11-15"

    run()
    assert read_bronze(spark, out).count() == n  # a restart adds nothing

    # a crash after the data was written and before the batch was marked done: it is replayed
    last = max((f for f in os.listdir(os.path.join(ck, "commits")) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(os.path.join(ck, "commits", name))
    run()
    assert read_bronze(spark, out).count() == n

    write(src + "/sub", f"all.{T0}.gz", [record(1, 0)])  # older name, later arrival, in a folder
    run()
    assert read_bronze(spark, out).count() == n + 1

    rows = read_rejects(spark, out).orderBy("file").collect()
    assert [bytes(r.record) if r.record is not None else None for r in rows] == [b"\xff\xff", None]

    plan = read_bronze(spark, out).where("date = '2023-11-15'")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("]")[0]
    assert "(row_kind#" in filters and "date#" in filters

    # a second version of the message adds a column; old rows read as null there
    cls2 = message_class(all_types(True), "all_types")
    write(src, f"all.{T0 + 8 * DAY}.gz", [cls2(i32=800, u64=T0 + 8 * DAY, added="new").SerializeToString()])
    fmt2 = MessageFormat(all_types(True), "all_types", date_field="u64")
    ingest_objects(spark, src, out, ck, fmt2, prefix="all").awaitTermination()
    table = read_bronze(spark, out)
    assert table.count() == n + 2
    assert [r.added for r in table.where("added is not null").collect()] == ["new"]
    with pytest.raises(SchemaConflict):
        ingest_objects(spark, src, out, ck, fmt, prefix="all")


def test_tasks_open_objects_themselves(spark, tmp_path):
    cls = message_class(all_types(), "all_types")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    fmt = MessageFormat(all_types(), "all_types", date_field="u64")
    for d in range(6):
        write(src, f"all.{T0 + d * DAY}.gz", [cls(i32=10 * d + k, u64=T0 + d * DAY).SerializeToString() for k in range(3)])
    listing = list_objects(spark, src)
    got = decode_objects(listing, fmt)
    assert sorted(r.i32 for r in got.collect()) == sorted(10 * d + k for d in range(6) for k in range(3))
    assert "content" not in got._jdf.queryExecution().executedPlan().toString()
    q = ingest_objects(spark, src, out, ck, fmt, before=T0 + 3 * DAY, open_in_tasks=True)
    q.awaitTermination()
    bronze = read_bronze(spark, out)
    assert bronze.count() == 12

    # one object inside the look-back was missed: the pending rows are its and the new ones
    missed = bronze.where("i32 between 20 and 22").select(F.col("file").alias("path"))
    ledger = read_ledger(spark, out).join(missed, "path", "left_anti")
    assert {r.file_ts for r in ledger.collect()} == {T0, T0 + DAY, T0 + 3 * DAY}
    rows = pending_rows(spark, src, ledger, fmt, look_back_millis=2 * DAY, task_bytes=100)
    assert sorted(r.i32 for r in rows.collect()) == [20, 21, 22, 40, 41, 42, 50, 51, 52]
    assert rows.rdd.getNumPartitions() == 8
    rows = pending_rows(spark, src, ledger, fmt, after=T0 + 4 * DAY, exclude=listing.limit(0))
    assert sorted(r.i32 for r in rows.collect()) == [50, 51, 52]


def test_large_objects_are_spread(spark, tmp_path, monkeypatch):
    import lakewright.sources.messages as messages

    monkeypatch.setattr(messages, "_SPREAD_BYTES", 2000)
    cls = message_class(all_types(), "all_types")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    fmt = MessageFormat(all_types(), "all_types", date_field="u64")
    write(src, f"all.{T0}.gz", [cls(i32=i, u64=T0).SerializeToString() for i in range(3000)] + [b"\xff\xff"])
    write(src, f"all.{T0 + 1}.gz", [cls(i32=-1, u64=T0).SerializeToString()])
    objects = read_objects(spark, src)
    spread = decode_spread(objects, fmt, 1000, 8)
    assert spread.where("i32 >= 0").groupBy(F.spark_partition_id()).count().count() > 4
    plain = decode_objects(objects, fmt)
    assert spread.count() == 3002 and spread.select("i32", "date", "file", "error").exceptAll(
        plain.select("i32", "date", "file", "error")
    ).isEmpty()
    q = ingest_objects(spark, src, out, ck, fmt, spread_above=1000)
    q.awaitTermination()
    assert ingest_counts(spark, out) == {"accepted": 3001, "rejected": 1}
    assert read_bronze(spark, out).select("i32").distinct().count() == 3001


def test_batches_and_streams_share_a_table(spark, tmp_path):
    cls = message_class(all_types(), "all_types")
    src, out, ck = (str(tmp_path / n) for n in ("s r%20c#", "out", "ck"))
    fmt = MessageFormat(all_types(), "all_types", date_field="u64")
    for i in range(4):
        write(src, f"all.{T0 + i}.gz", [cls(i32=i, u64=T0).SerializeToString()])
    write(src, f"all.{T0 + 4}.gz", [b"\xff\xff"])  # nothing but a reject
    write(src, f"all.{T0 + 5}.gz", [])
    assert read_ledger(spark, out).count() == 0 and ingest_counts(spark, out) == {"accepted": 0, "rejected": 0}
    ingest_objects(spark, src, out, ck, fmt, before=T0 + 1, open_in_tasks=True).awaitTermination()
    assert read_rejects(spark, out).count() == 0  # the window holds for rejects too
    for _ in range(2):  # a repeat adds nothing, also no object without records
        ingest_pending(spark, src, out, fmt)
        assert {r.file_ts - T0: r.frames for r in read_ledger(spark, out).collect()} == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 0}
        assert sorted(r.i32 for r in read_bronze(spark, out).collect()) == [0, 1, 2, 3]
        assert ingest_counts(spark, out) == {"accepted": 4, "rejected": 1}
    write(src, f"all.{T0 + 6}.gz", [cls(i32=6, u64=T0).SerializeToString()])
    ingest_objects(spark, src, out, ck, fmt, already_read=read_ledger(spark, out)).awaitTermination()
    assert ingest_counts(spark, out) == {"accepted": 5, "rejected": 1}


def test_counts_of_many_micro_batches(spark, tmp_path):
    cls = message_class(all_types(), "all_types")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    for i in range(105):
        write(src, f"all.{T0 + i}.gz", [cls(i32=i).SerializeToString(), *[b"\xff\xff"] * (i % 2)])
    ingest_objects(
        spark, src, out, ck, MessageFormat(all_types(), "all_types"), source_options={"maxFilesPerTrigger": "1"}
    ).awaitTermination()
    assert ingest_counts(spark, out) == {"accepted": 105, "rejected": 52}


def test_many_empty_records(spark, tmp_path):
    src = str(tmp_path / "src")
    write(src, f"a.{T0}.gz", [b""] * 45_000)
    assert read_records(read_objects(spark, src)).where("length(record) = 0").count() == 45_000


def test_field_names_must_not_clash():
    with pytest.raises(ValueError, match="file"):
        MessageFormat(clashing(), "clashing").schema()


def test_exclusions(spark, tmp_path):
    cls = message_class(all_types(), "all_types")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    for i in range(4):
        write(src, f"all.{T0 + i}.gz", [cls(i32=i).SerializeToString()])
    ledger = read_objects(spark, src).where(F.col("path").endswith(f"all.{T0 + 1}.gz"))
    fmt = MessageFormat(all_types(), "all_types")
    ingest_objects(
        spark, src, out, ck, fmt, exclude=[f"all.{T0}.gz"], already_read=ledger, before=T0 + 2
    ).awaitTermination()
    assert [r.i32 for r in read_bronze(spark, out).collect()] == [2]


def test_source_options_reach_the_file_source(spark, tmp_path):
    cls = message_class(all_types(), "all_types")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    for i in range(3):
        write(src, f"all.{T0 + i}.gz", [cls(i32=i).SerializeToString()])
    q = ingest_objects(
        spark, src, out, ck, MessageFormat(all_types(), "all_types"), source_options={"maxFilesPerTrigger": "1"},
        max_bytes_per_trigger=None,
    )
    q.awaitTermination()
    assert [p.numInputRows for p in q.recentProgress if p.numInputRows] == [1, 1, 1]
    assert read_bronze(spark, out).count() == 3


def test_evolve():
    old = T.StructType.fromDDL("a int, s struct<x:int>")
    new = T.StructType.fromDDL("s struct<x:int,y:string>, b array<int>, a int")
    assert evolve(old, new).simpleString() == "struct<a:int,s:struct<x:int,y:string>,b:array<int>>"
    with pytest.raises(SchemaConflict, match="missing"):
        evolve(new, old)
    with pytest.raises(SchemaConflict, match="s.x"):
        evolve(old, T.StructType.fromDDL("a int, s struct<x:string>"))
