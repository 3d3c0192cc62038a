import os
import subprocess
import sys
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakewright.functions import b58encode_checked
from lakewright.plans.rewards import active_entities, iot_rewards, latest_by_key, mobile_rewards
from lakewright.plans.sql_job import run_from_env, run_sql_job
from lakewright.session import build_session, conf_from_env, s3a_conf
from lakewright.sources.exports import frame_object
from lakewright.sources.listing import read_objects
from lakewright.sources.messages import MessageFormat, decode_objects
from lakewright.sources.tables import register_tables, tables_from_env
from lakewright.streaming.triggers import trigger_options
from tests.protos import message_class, mobile_share


def reward_rows(spark):
    return spark.createDataFrame(
        [
            (dt.date(2024, 3, 1), 1, 10, (bytearray(b"\1"), 5, 0, 0)),
            (dt.date(2024, 3, 2), 1, 20, (bytearray(b"\1"), 0, 0, 0)),
            (dt.date(2024, 3, 2), 1, 15, (bytearray(b"\1"), 0, 7, 0)),
            (dt.date(2023, 3, 2), 1, 99, (bytearray(b"\2"), 1, 1, 1)),
        ],
        "date date, start_period long, end_period long, "
        "gateway_reward struct<hotspot_key: binary, beacon_amount: long, witness_amount: long, dc_transfer_amount: long>",
    )


def key_text(spark, *keys):
    df = spark.createDataFrame([(i, bytearray(k)) for i, k in enumerate(keys)], "i int, k binary")
    return [r.c for r in df.select("i", b58encode_checked("k").alias("c")).orderBy("i").collect()]


def test_silver_and_gold(spark, tmp_path):
    cls = message_class(mobile_share(), "mobile_share")
    day = 1_709_251_200  # 2024-03-01
    shares = [
        cls(start_period=day, end_period=day + 5, radio_reward=dict(hotspot_key=b"\1", cbsd_id="c", poc_reward=3)),
        cls(start_period=day, end_period=day + 6, gateway_reward=dict(hotspot_key=b"\2", dc_transfer_reward=4)),
        cls(start_period=day, end_period=day + 7, gateway_reward=dict(hotspot_key=b"\2")),
        cls(start_period=day, end_period=day + 8),
    ]
    (tmp_path / "mobile.1709251200000.gz").write_bytes(frame_object([m.SerializeToString() for m in shares]))
    texts = key_text(spark, b"\1", b"\2")
    for missing in ("default", "null"):
        fmt = MessageFormat(mobile_share(), "mobile_share", "start_period", 86400, missing=missing)
        silver = mobile_rewards(decode_objects(read_objects(spark, str(tmp_path)), fmt))
        rows = silver.orderBy("end_period").collect()
        assert [r.entity_key for r in rows] == [texts[0], texts[1], texts[1], None]
        assert rows[0].poc_amount == 3 and rows[0].cbsd_id == "c" and str(rows[0].date) == "2024-03-01"
        gold = active_entities(iot_rewards(reward_rows(spark)), silver, as_of=dt.date(2024, 3, 3)).collect()
        assert {(int(r.most_recent_ts), r.entity_key, r.sub_dao) for r in gold} == {
            (15, texts[0], "iot"),
            (day + 5, texts[0], "mobile"),
            (day + 6, texts[1], "mobile"),
        }


def test_latest_by_key_encodes_after_grouping(spark):
    df = latest_by_key(reward_rows(spark), "gateway_reward.hotspot_key", "end_period", "hotspot_key")
    texts = key_text(spark, b"\1", b"\2")
    assert {tuple(r) for r in df.collect()} == {(20, texts[0]), (99, texts[1])}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("HashAggregate")


SILVER_SQL = """
select date, end_period, b58encodeChecked(gateway_reward.hotspot_key) as entity_key,
       from_epoch_millis(end_period * 1000) as at, gateway_reward.beacon_amount as beacon_amount
from reward_share where gateway_reward.beacon_amount > 0;
"""


def test_batch_job(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    reward_rows(spark).write.partitionBy("date").parquet(src)
    for _ in range(2):
        run_sql_job(spark, SILVER_SQL, {"REWARD_SHARE": src}, out)
    rows = spark.read.parquet(out).orderBy("end_period").collect()
    assert [(str(r.date), r.end_period, r.beacon_amount) for r in rows] == [("2024-03-01", 10, 5), ("2023-03-02", 99, 1)]
    assert rows[0].entity_key == key_text(spark, b"\1")[0] and str(rows[0].at) == "1970-01-01 00:00:10"


def test_stream_job_restarts_without_duplicates(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    reward_rows(spark).write.partitionBy("date").parquet(src)

    def run(sql=SILVER_SQL, checkpoint=ck):
        run_sql_job(
            spark, sql, {"reward_share": src}, out, streaming=True, partition_by=["date"], checkpoint=checkpoint,
            trigger="AvailableNow",
        ).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 2
    assert run() == 2
    reward_rows(spark).limit(1).write.mode("append").partitionBy("date").parquet(src)
    assert run() == 3
    with pytest.raises(ValueError, match="batch"):
        run("select max(end_period) m, date from reward_share group by date", ck + "2")


def test_stream_job_on_an_interval(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    reward_rows(spark).write.parquet(src)
    query = run_sql_job(
        spark, SILVER_SQL, {"reward_share": src}, out, streaming=True, partition_by=["date"], checkpoint=ck, interval="1 second"
    )
    try:
        query.processAllAvailable()
        reward_rows(spark).write.mode("append").parquet(src)
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == 4


def test_stream_job_refuses_what_cannot_work(spark, tmp_path):
    src = str(tmp_path / "src")
    reward_rows(spark).write.parquet(src)
    tables = {"reward_share": src}
    with pytest.raises(ValueError, match="checkpoint"):
        run_sql_job(spark, SILVER_SQL, tables, "o", streaming=True)
    with pytest.raises(ValueError, match="Continuous"):
        run_sql_job(spark, SILVER_SQL, tables, "o", streaming=True, checkpoint="c", trigger="Continuous")
    with pytest.raises(ValueError, match="no streaming table"):
        run_sql_job(spark, "select 1 as date", tables, "o", streaming=True, checkpoint="c")


def test_job_from_environment(spark, tmp_path):
    src, out, query = str(tmp_path / "src"), str(tmp_path / "out"), tmp_path / "q.sql"
    reward_rows(spark).write.parquet(src)
    query.write_text(SILVER_SQL)
    env = {"TABLE_REWARD_SHARE": src, "OUTPUT": out, "QUERY_PATH": str(query), "BATCH_PROCESSING": "true"}
    run_from_env(env, fmt="parquet")
    assert spark.read.parquet(out).count() == 2
    env.update(BATCH_PROCESSING="false", OUTPUT=out + "-s", CHECKPOINT=str(tmp_path / "ck"), TRIGGER="AvailableNow", PARTITION_BY="date")
    run_from_env(env, fmt="parquet")
    assert spark.read.parquet(out + "-s").count() == 2


def test_command_line(tmp_path, spark):
    """The module as a process of its own, its environment as the only input."""
    src, query = str(tmp_path / "src"), tmp_path / "q.sql"
    reward_rows(spark).write.parquet(src)
    query.write_text(SILVER_SQL)
    for name, more in (("b", {"BATCH_PROCESSING": "true"}), ("s", {"CHECKPOINT": str(tmp_path / "ck"), "TRIGGER": "AvailableNow", "PARTITION_BY": "date"})):
        out = str(tmp_path / name)
        env = {"TABLE_REWARD_SHARE": src, "OUTPUT": out, "QUERY_PATH": str(query), "OUTPUT_FORMAT": "parquet", **more}
        command = [sys.executable, "-m", "lakewright.plans.sql_job"]
        subprocess.run(command, env=os.environ | env | {"SPARK_MASTER": "local[2]"}, check=True, timeout=300, capture_output=True)
        assert spark.read.parquet(out).count() == 2


def test_settings():
    assert conf_from_env({"SPARK_SQL_ANSI_ENABLED": "true", "PATH": "x"}) == {"spark.sql.ansi.enabled": "true"}
    assert tables_from_env({"TABLE_Iot_Share": "p", "T": "q"}) == {"iot_share": "p"}
    conf = s3a_conf("localhost:9000", "k", "s", path_style=True, ssl=False, requester_pays=True)
    assert conf["spark.hadoop.fs.s3a.requester.pays.enabled"] == "true" and len(conf) == 6
    assert s3a_conf("localhost:9000", bucket="lake") == {"spark.hadoop.fs.s3a.bucket.lake.endpoint": "localhost:9000"}
    assert trigger_options() == {"processingTime": "4 hours"}
    assert trigger_options("AvailableNow") == {"availableNow": True}
    for bad in ("Continuous", "Sometimes"):
        with pytest.raises(ValueError):
            trigger_options(bad)


def test_build_session_layers(spark):
    session = build_session("x", conf={"spark.sql.shuffle.partitions": "8", "my.key": "conf"}, env={"SPARK_MY": "e"})
    assert session.conf.get("my.key") == "conf" and session.conf.get("spark.my") == "e"


def test_register_tables(spark, sf):
    assert register_tables(spark, {"NATION": f"{sf}/nation.parquet"}) == ["nation"]
    day = spark.sql("select * from nation limit 5")
    assert day.count() == 5
    plan = spark.table("nation").select(F.col("n_name"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<n_name:string>" in plan
