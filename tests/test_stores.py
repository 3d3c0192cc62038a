"""Settings of object stores in tasks, batches shown by a commit, and the cursor over a listing."""

import json
import os

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from lakewright.plans.backfill import pending_objects_of
from lakewright.session import s3a_conf
from lakewright.sources import commits
from lakewright.sources.framing import read_records
from lakewright.sources.listing import list_objects
from lakewright.sources.messages import MessageFormat
from lakewright.sources.object_cursor import CursorReader, deal
from lakewright.sources.stores import s3_arguments, store_of, store_settings, tasks_can_open
from lakewright.streaming import ingest
from lakewright.streaming.ingest import ingest_counts, ingest_objects, ingest_pending, read_bronze, read_ledger
from tests.protos import all_types, message_class
from tests.test_ingest import DAY, T0, write

FMT = MessageFormat(all_types(), "all_types", date_field="u64")


@pytest.fixture
def s3a(spark):
    """Settings of two buckets, as a session has them."""
    conf = s3a_conf(access_key="all", secret_key="s0", region="eu-west-1")
    conf |= s3a_conf(endpoint="http://store.test:9000", access_key="k1", secret_key="s1", path_style=True, bucket="one.raw")
    conf |= s3a_conf(requester_pays=True, bucket="paid")
    names = [k.removeprefix("spark.hadoop.") for k in conf]
    for name, value in zip(names, conf.values()):
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def test_settings_of_two_buckets(spark, s3a):
    settings = store_settings(spark)
    assert s3_arguments(settings, "one.raw") == {
        "access_key": "k1", "secret_key": "s1", "region": "eu-west-1", "endpoint_override": "store.test:9000", "force_virtual_addressing": False, "scheme": "http",
    }
    other = s3_arguments(settings, "other")
    assert (other["access_key"], other["secret_key"], other["region"]) == ("all", "s0", "eu-west-1")
    assert "endpoint_override" not in other and other.get("scheme", "https") == "https"
    fs, name = store_of("s3a://other/a b/c%20d.1.gz", settings)
    assert isinstance(fs, pafs.S3FileSystem) and fs.region == "eu-west-1" and name == "other/a b/c%20d.1.gz"
    assert tasks_can_open("s3a://other/x", settings) and not tasks_can_open("s3a://paid/x", settings)
    with pytest.raises(PermissionError, match="paid"):
        store_of("s3a://paid/x", settings)


@pytest.mark.parametrize(
    "settings, want",
    [
        ({}, {}),
        ({"fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider", "fs.s3a.access.key": "k"}, {"anonymous": True}),
        ({"fs.s3a.access.key": "k", "fs.s3a.secret.key": "s", "fs.s3a.session.token": "t"}, {"access_key": "k", "secret_key": "s", "session_token": "t"}),
        ({"fs.s3a.aws.credentials.provider": "a.AssumedRoleCredentialProvider", "fs.s3a.assumed.role.arn": "arn:x"}, {"role_arn": "arn:x"}),
        ({"fs.s3a.endpoint": "s3.amazonaws.com"}, {}),
        ({"fs.s3a.endpoint": "h:1/", "fs.s3a.connection.ssl.enabled": "false"}, {"endpoint_override": "h:1", "force_virtual_addressing": True, "scheme": "http"}),
        ({"fs.s3a.proxy.host": "p", "fs.s3a.proxy.port": "8080"}, {"proxy_options": {"scheme": "http", "host": "p", "port": 8080}}),
    ],
)
def test_arguments(settings, want):
    assert s3_arguments(settings, "b") == want


def test_tasks_get_the_settings(spark, s3a, tmp_path, monkeypatch):
    """What opens an object in a task sees the session's settings: here it fails for a bucket that tasks must not open."""
    df = spark.createDataFrame([("s3a://paid/all.1.gz", 1)], "path string, length long")
    with pytest.raises(Exception, match="the requester pays for s3a://paid"):
        read_records(df).count()
    assert read_records(df.where("false")).count() == 0


def test_contents_come_from_spark_where_tasks_cannot_open(spark, tmp_path, monkeypatch):
    cls = message_class(all_types(), "all_types")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    for i in range(4):
        write(src, f"all.{T0 + i}.gz", [cls(i32=i, u64=T0).SerializeToString()])
    closed = lambda path, settings: False
    monkeypatch.setattr("lakewright.plans.backfill.tasks_can_open", closed)
    monkeypatch.setattr("lakewright.streaming.ingest.tasks_can_open", closed)
    ingest_objects(spark, src, out, ck, FMT, before=T0 + 1, open_in_tasks=True).awaitTermination()
    pending = pending_objects_of(spark, src, read_ledger(spark, out))
    assert "content" in pending.columns and pending.count() == 2
    for _ in range(2):
        ingest_pending(spark, src, out, FMT)
    assert sorted(r.i32 for r in read_bronze(spark, out).collect()) == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="look-back"):
        ingest_objects(spark, src, out, ck, FMT, look_back_millis=DAY)


def test_a_batch_is_shown_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    cls = message_class(all_types(), "all_types")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for i in range(5):
        write(src, f"all.{T0 + i * DAY}.gz", [cls(i32=i, u64=T0 + i * DAY).SerializeToString()])
    show = commits._show

    def stop(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(commits, "_show", stop)
    with pytest.raises(KeyboardInterrupt):
        ingest_pending(spark, src, out, FMT)
    folder = f"{out}-batches"
    assert len(os.listdir(f"{folder}/data")) == 1  # all is written, nothing is shown
    assert read_bronze(spark, out).count() == read_ledger(spark, out).count() == 0
    monkeypatch.setattr(commits, "_show", show)
    for _ in range(2):
        ingest_pending(spark, src, out, FMT)
        assert sorted(r.i32 for r in read_bronze(spark, out).collect()) == [0, 1, 2, 3, 4]
        assert ingest_counts(spark, out) == {"accepted": 5, "rejected": 0}
    assert commits.version(spark, folder) == 1  # the repeat had nothing to commit
    plan = read_bronze(spark, out).where("date = '2023-11-15'")._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert commits.sweep(spark, folder, 0) == []
    (stale,) = commits.sweep(spark, folder, 2**62)
    assert os.listdir(f"{folder}/data") != [stale] and read_bronze(spark, out).count() == 5


def test_of_two_writers_the_second_plans_anew(spark, tmp_path, monkeypatch):
    cls = message_class(all_types(), "all_types")
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    write(src, f"all.{T0}.gz", [cls(i32=0, u64=T0).SerializeToString()])
    decode, runs = ingest.decode_all, []

    def overtaken(pending, fmt):
        """While the first run plans, another takes the same object."""
        runs.append(pending.count())
        if len(runs) == 1:
            write(src, f"all.{T0 + 1}.gz", [cls(i32=1, u64=T0).SerializeToString()])
            monkeypatch.setattr(ingest, "decode_all", decode)
            ingest_pending(spark, src, out, FMT, before=T0)
            monkeypatch.setattr(ingest, "decode_all", overtaken)
        return decode(pending, fmt)

    monkeypatch.setattr(ingest, "decode_all", overtaken)
    ingest_pending(spark, src, out, FMT)
    assert runs == [1, 1] and commits.version(spark, f"{out}-batches") == 2
    assert sorted(r.i32 for r in read_bronze(spark, out).collect()) == [0, 1]
    df = spark.range(1)
    root = str(tmp_path / "plain")
    assert commits.append_batch(df, root, 0) == 1 and commits.append_batch(df, root, 1) == 2
    with pytest.raises(commits.CommitConflict):
        commits.append_batch(df, root, 1)
    assert commits.read_batches(spark, root, df.schema).count() == 2 and len(os.listdir(f"{root}/data")) == 2


def reader(root, look_back, **more):
    options = {"path": str(root), "settings": "{}", "lookback": look_back, "taskbytes": 1000, "tasks": 2, **more}
    return CursorReader({k: str(v) for k, v in options.items()})


def rows_of(parts):
    return [row for part in parts for row in part.rows]


def test_cursor_state_stays_within_the_look_back(tmp_path):
    """A hundred batches, some names late: each name once, and the offset never holds more than one look-back of names."""
    cursor, offset, got, width = reader(tmp_path, 10), {"newest": None, "recent": []}, [], []
    for batch in range(100):
        for k in range(5):
            write(tmp_path, f"all.{1000 + 5 * batch + k - (4 if k == 2 else 0)}.gz" if k != 2 else f"late{batch}.{1000 + 5 * batch - 4}.gz", b"x" * 10)
        end = cursor.latestOffset()
        got += rows_of(cursor.partitions(offset, end))
        offset = json.loads(json.dumps(end))
        width.append(len(json.dumps(offset)))
        if batch % 10 == 0:  # a restart knows no more than the offset
            cursor = reader(tmp_path, 10)
            assert cursor.partitions(offset, cursor.latestOffset()) == []
    assert len(got) == len(set(got)) == 500 and {r[0].rpartition("/")[2] for r in got} == set(os.listdir(tmp_path))
    assert max(width[50:]) <= max(width[5:20]) + 40


def test_cursor_replays_late_names_and_windows(tmp_path):
    for t in (100, 150, 200):
        write(tmp_path / "sub", f"all.{t}.gz", b"1" * t)
    write(tmp_path, "notes.txt", b"")
    write(tmp_path, "other.170.gz", b"")
    cursor = reader(tmp_path, 60, prefix="all")
    start, end = cursor.initialOffset(), cursor.latestOffset()
    assert end == {"newest": 200, "recent": ["sub/all.150.gz", "sub/all.200.gz"]}
    first = rows_of(cursor.partitions(start, end))
    assert first == [(f"{tmp_path}/sub/all.{t}.gz", t, t) for t in (100, 150, 200)]
    write(tmp_path, "all.145.gz", b"")  # within the look-back
    write(tmp_path, "all.139.gz", b"")  # behind it: left to the ledger
    assert rows_of(reader(tmp_path, 60, prefix="all").partitions(end, end)) == []
    again = reader(tmp_path, 60, prefix="all")  # after a failure the batch is planned again, and the late names are not part of it
    assert [r for r in rows_of(again.partitions(start, end)) if r not in first] == [(f"{tmp_path}/all.139.gz", 0, 139)]
    later = again.latestOffset()
    assert [r[2] for r in rows_of(again.partitions(end, later))] == [145]
    write(tmp_path, "all.300.gz", b"")
    assert [r[2] for r in rows_of(again.partitions(later, again.latestOffset()))] == [300]
    window = reader(tmp_path, 60, prefix="all", after=139, before=200)
    assert [r[2] for r in rows_of(window.partitions(start, window.latestOffset()))] == [145, 150, 200]
    empty = reader(tmp_path / "none", 60)
    assert empty.latestOffset() == start and empty.partitions(start, start) == []


def test_parts_of_about_equal_bytes():
    found = [(f"n{i}", size, i) for i, size in enumerate([10, 10, 500, 10, 0, 0, 990, 10])]
    parts = deal(found, 500, 2)
    assert [f for part in parts for f in part] == found and all(sum(f[1] for f in p) <= 500 or len(p) == 1 for p in parts)
    assert deal([], 500, 2) == [] and len(deal(found[:2], 500, 2)) == 2


def test_cursor_stream(spark, tmp_path):
    cls = message_class(all_types(), "all_types")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))

    def put(day):
        write(src, f"all.{T0 + day * DAY}.gz", [cls(i32=day, u64=T0 + day * DAY).SerializeToString()])

    def run():
        query = ingest_objects(spark, src, out, ck, FMT, look_back_millis=2 * DAY)
        query.awaitTermination()
        return sorted(r.i32 for r in read_bronze(spark, out).collect())

    run()  # nothing is there yet
    for day in (0, 5, 7):
        put(day)
    assert run() == [0, 5, 7]
    put(6)
    put(1)  # too late for the stream
    assert run() == run() == [0, 5, 6, 7]
    ingest_pending(spark, src, out, FMT)
    assert sorted(r.i32 for r in read_bronze(spark, out).collect()) == [0, 1, 5, 6, 7]
    put(9)
    assert run() == [0, 1, 5, 6, 7, 9]  # a batch beside it does not disturb the stream
    listing = list_objects(spark, src).select(F.max("file_ts")).first()[0]
    assert listing == T0 + 9 * DAY
