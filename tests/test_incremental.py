"""Quantiles per group, tables kept up by a stream, and jobs that join a stream with fixed tables."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakewright.operators import quantile
from lakewright.operators.outliers import trim_above_group_quantile
from lakewright.operators.quantile import narrowed_quantiles
from lakewright.plans.rewards import active_in_network
from lakewright.plans.sql_job import run_from_env, run_sql_job
from lakewright.sources import commits
from lakewright.sources.tables import register_tables
from lakewright.streaming.gold import maintain_latest, merge_latest, read_active

VALUES = st.one_of(st.none(), st.floats(), st.sampled_from([0.0, -0.0, 1.0, 1e300, -1e300, 5e-324, float("inf")]), st.integers(-5, 5).map(float))


def builtin(df, by, q):
    """Spark's own percentile; both zeros are one value."""
    plain = F.when(F.col("x") == 0, F.lit(0.0)).otherwise(F.col("x"))
    return {tuple(r)[:-1]: r.value for r in df.where("x is not null").groupBy(*by).agg(F.percentile(plain, F.lit(q)).alias("value")).collect()}


def same(a, b):
    return a == b or a != a and b != b or a == pytest.approx(b, rel=1e-12)


def test_quantile_per_group(spark, monkeypatch):
    @settings(max_examples=12, deadline=None)
    @given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 1), VALUES), max_size=60), st.sampled_from([0.0, 0.3, 0.5, 0.999, 1.0]), st.sampled_from([0, 50_000]))
    def check(rows, q, small):
        monkeypatch.setattr(quantile, "_SMALL_COUNT", small)  # 0: every group goes through the narrowing passes
        df = spark.createDataFrame(rows, "k string, _cut int, x double")
        got = {tuple(r)[:-1]: r.value for r in narrowed_quantiles(df, ["k", "_cut"], "x", q).collect()}
        want = builtin(df, ["k", "_cut"], q)
        assert got.keys() == want.keys() and all(same(got[k], want[k]) for k in got)

    check()


def test_quantile_of_many_rows_in_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(quantile, "_SMALL_COUNT", 100)
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 1000).otherwise(-1).alias("k"), (F.xxhash64("id") / 7).alias("x"))
    got = {(r.k,): r.value for r in narrowed_quantiles(df, ["k"], "x", 0.999).collect()}
    assert got == {k: pytest.approx(v, rel=1e-15) for k, v in builtin(df, ["k"], 0.999).items()} and len(got) == 1001
    trimmed = trim_above_group_quantile(df, ["k"], "x", 0.5)
    assert trimmed.columns == ["k", "x"] and 99_000 < trimmed.count() < 100_001


def put(spark, rows, path):
    spark.createDataFrame(rows, "date date, entity_key string, end_period long, a double, b double").coalesce(1).write.mode("append").parquet(path)


def test_gold_is_kept_up(spark, tmp_path, monkeypatch):
    source, gold, checkpoint = (str(tmp_path / n) for n in ("source", "gold", "checkpoint"))
    day = dt.date(2024, 3, 1)
    batches = [
        [(day, "x", 10, 1.0, 0.0), (day, "y", 20, 0.0, 0.0), (day, None, 5, 1.0, 0.0), (None, "z", 9, 1.0, 1.0)],
        [(day, "x", 7, 0.0, 2.0), (day - dt.timedelta(40), "y", 3, 1.0, None), (dt.date(2023, 1, 1), "old", 99, 1.0, 1.0)],
        [(day - dt.timedelta(40), "x", 50, 1.0, 0.0), (day, "y", 21, None, 4.0)],
    ]

    def run():
        schema = spark.read.parquet(source).schema
        maintain_latest(spark.readStream.schema(schema).parquet(source), gold, checkpoint, ["a", "b"]).awaitTermination()
        got = sorted(map(tuple, read_active(spark, gold, "net", day, 62).collect()), key=str)
        want = sorted(map(tuple, active_in_network(spark.read.parquet(source), "net", ["a", "b"], day, 62).collect()), key=str)
        assert got == want
        return got

    for rows in batches:
        put(spark, rows, source)
        run()
    assert run() == [(21, "y", "net"), (5, None, "net"), (50, "x", "net")] and commits.version(spark, gold) == 3
    touched = [set(parts) for *_, parts in commits.commits(spark, gold)]
    assert touched == [{"m2024-03"}, {"m2024-03", "m2024-01", "m2023-01"}, {"m2024-01", "m2024-03"}]
    merge_latest(spark.read.parquet(source).withColumn("end_period", F.lit(10**6)), 2, gold, ["a", "b"])  # a batch that is there already
    assert max(r[0] for r in run()) == 50
    # a run that ends between data and commit shows nothing, and its repeat counts once
    put(spark, [(day, "x", 60, 1.0, 0.0)], source)
    show = commits._show
    monkeypatch.setattr(commits, "_show", lambda *a: 1 / 0)
    with pytest.raises(Exception, match="ZeroDivision"):
        run()
    assert commits.version(spark, gold) == 3
    monkeypatch.setattr(commits, "_show", show)
    assert (60, "x", "net") in run() and commits.version(spark, gold) == 4


def test_parts_are_replaced(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    commits.replace_parts(rows, root, 0, "p", ["a", "b"])
    commits.replace_parts(rows.where("n = 1").withColumn("n", F.lit(7)), root, 1, "p", ["a", "b"])
    assert [tuple(r) for r in commits.read_parts(spark, root, rows.schema, "p").collect()] == [(7, "a")]
    with pytest.raises(commits.CommitConflict):
        commits.replace_parts(rows, root, 1, "p", ["a"])
    assert commits.read_parts(spark, root, rows.schema, "p", ["b"]).count() == 0


def test_stream_joined_with_a_fixed_table(spark, tmp_path):
    stream, fixed, out, query = (str(tmp_path / n) for n in ("stream", "fixed", "out", "q.sql"))
    spark.range(5).selectExpr("id", "current_date() as date").write.parquet(stream)
    spark.createDataFrame([(1, "one"), (3, "three")], "id long, name string").write.parquet(fixed)
    sql = "select s.id, name, date from s join f on s.id = f.id"
    with open(query, "w") as file:
        file.write(sql)
    env = {"QUERY_PATH": query, "OUTPUT": out, "TABLE_S": stream, "TABLE_F": fixed, "BATCH_TABLES": "f", "PARTITION_BY": "date",
           "CHECKPOINT": f"{out}-checkpoint", "TRIGGER": "AvailableNow"}
    for ids in ([1, 3], [1, 3], [1, 1, 3]):
        if len(ids) == 3:
            spark.range(1, 2).selectExpr("id", "current_date() as date").write.mode("append").parquet(stream)
        run_from_env(env, "parquet")
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == ids
    register_tables(spark, {"S": stream, "F": fixed}, streaming=["s"])
    assert spark.table("s").isStreaming and not spark.table("f").isStreaming
    with pytest.raises(ValueError, match="nowhere"):
        run_sql_job(spark, sql, {"S": stream}, out, streaming=["nowhere"], checkpoint=out)
