import datetime as dt
import os
import math
import random
import tempfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakewright.operators import batching
from lakewright.operators.batching import _chain, _chunk_summary, _pass, assign_batches
from lakewright.operators.history import append_history, extend_history, holds_date, replace_dates
from lakewright.operators.outliers import keep_positive, trim_above_quantile
from lakewright.operators.quantile import narrowed_quantile
from lakewright.operators.ranking import rank_order, share_by_group, top_groups
from lakewright.operators.resume import pending_objects, resume_point
from lakewright.operators.summary import column_summary
from lakewright.plans.country_ranking import daily_country_ranking, latest_ranking, located_amounts, ranked_share, read_history
from lakewright.scratch import scratch_dir, stage, staged
from lakewright.sources.listing import millis_glob, name_millis, name_prefix, object_uri, select_objects, strip_root
from lakewright.sources.schema_history import union_versions

DAY = 86_400_000
T0 = 1_700_000_000_000


# --- quantile ---------------------------------------------------------------


def doubles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0],
        [3.0] * 100,
        [0.0, -0.0, 0.0, 1.0],
        [None, 4.0, None, 1.0],
        [-1e300, -1.0, 0.0, 1e-300, 1.0, 1e300],
        [float(i) for i in range(1000)],
        [1.0] * 500 + [2.0] * 500,
        [math.nextafter(1.0, 2.0), 1.0, math.nextafter(1.0, 0.0)] * 3,
        [float("-inf"), 1.0, 2.0, float("inf")],
    ],
)
def test_narrowed_quantile_equals_builtin(spark, values):
    df = doubles(spark, values)
    qs = [0.0, 0.25, 0.5, 0.999, 1.0]
    want = df.agg(*(F.percentile("x", F.lit(q)).alias(f"q{i}") for i, q in enumerate(qs))).first()
    for q, expected in zip(qs, want):
        got = narrowed_quantile(df, "x", q)
        assert got == expected or (math.isnan(got) and math.isnan(expected)), (q, got, expected)


def test_narrowed_quantile_of_nothing(spark):
    assert narrowed_quantile(doubles(spark, [None]), "x", 0.5) is None


@pytest.mark.parametrize("small", [0, 10])
def test_narrowed_quantile_with_many_rows_left(spark, monkeypatch, small):
    """The linear passes, forced by a tiny row limit, on heavy-tailed and hot values."""
    import lakewright.operators.quantile as module

    monkeypatch.setattr(module, "_SMALL_COUNT", small)
    rnd = random.Random(3)
    values = [round(rnd.lognormvariate(3, 2), 2) for _ in range(3000)] + [17.25] * 1500
    values += [1.0 + i * 1e-12 for i in range(2000)]
    df = doubles(spark, values).cache()
    for q in (0.1, 0.5, 0.77, 0.999):
        assert narrowed_quantile(df, "x", q) == df.agg(F.percentile("x", F.lit(q))).first()[0]


def test_trim_methods_agree_and_drop_the_maximum(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_extendedprice")
    a = trim_above_quantile(df, "l_extendedprice", method="builtin")
    b = trim_above_quantile(df, "l_extendedprice", method="narrow")
    assert a.count() == b.count() == df.count() - 6
    assert a.exceptAll(b).isEmpty()
    assert trim_above_quantile(doubles(spark, [9.0]), "x").isEmpty()
    pushed = b._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_extendedprice" in pushed


def test_approximate_trim_is_off_by_few_ranks(spark):
    df = spark.range(1, 100_001).select(F.col("id").alias("x"))
    kept = trim_above_quantile(df, "x", 0.999, method="approx").count()
    assert abs(kept - 99_900) <= 5
    with pytest.raises(ValueError):
        trim_above_quantile(df, "x", method="guess")


# --- ranking ----------------------------------------------------------------


def ranking_input(spark):
    amounts = spark.createDataFrame(
        [("g1", 10.0), ("g1", 0.0), ("g2", -3.0), ("g2", 10.0), ("g3", 4.0), ("g4", 50.0), ("g9", 7.0), ("g1", None)],
        "gateway string, amount double",
    )
    places = spark.createDataFrame(
        [("g1", "A"), ("g2", "B"), ("g3", None), ("g4", "C")], "gateway string, country string"
    )
    return amounts, places


def test_ranked_share(spark):
    amounts, places = ranking_input(spark)
    # kept: A 10, B 10, null 4, C 50; the quantile is just below 50, so C goes
    for write_join in (True, False):
        rows = rank_order(ranked_share(amounts, places, write_join=write_join), "country").collect()
        assert [(r.country, r["sum"], r.percent) for r in rows] == [("A", 10.0, 50.0), ("B", 10.0, 50.0)]


def test_quantile_counts_amounts_without_place(spark):
    amounts = spark.createDataFrame([(f"g{i}", float(i)) for i in range(1, 6)], "gateway string, amount double")
    places = spark.createDataFrame([(f"g{i}", None if i == 5 else "A") for i in range(1, 6)], "gateway string, country string")
    # the largest amount has no place: it takes the cut, the other four stay
    assert ranked_share(amounts, places).first()["sum"] == 10.0


def test_hot_entity_is_split(spark):
    """One gateway holds a third of the rows and the places are too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        amounts = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("gateway"),
            (F.col("id") + 1).alias("amount"),
        )
        places = spark.range(1000).select(F.col("id").alias("gateway"), F.concat(F.lit("c"), F.col("id") % 5).alias("country"))
        joined = located_amounts(amounts, places, "gateway", "amount", "country")
        assert joined.agg(F.sum("amount")).first()[0] == 300_000 * 300_001 // 2
        joined.collect()
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
        small = ranked_share(amounts, places, amount="amount", write_join=False)
        large = ranked_share(amounts, places, amount="amount", write_join=True)
        assert rank_order(small, "country").collect() == rank_order(large, "country").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_zero_total_gives_null_percent(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), ("b", 0.0)], "g string, v double")
    assert {r.percent for r in share_by_group(df, "g", "v").collect()} == {None}
    assert top_groups(share_by_group(df, "g", "v"), "g", 1).first().g == "a"


def test_daily_ranking_runs_once_per_day(spark, tmp_path):
    amounts, places = ranking_input(spark)
    a, p, h = (str(tmp_path / n) for n in ("a", "p", "h"))
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    for i, day in enumerate(days):
        amounts.withColumn("amount", F.col("amount") * (i + 1)).withColumn("date", F.lit(day)).write.mode(
            "append"
        ).partitionBy("date").parquet(a)
    places.write.parquet(p)
    assert read_history(spark, h) is None
    for day in days:
        assert daily_country_ranking(spark, a, p, h, day, "amount")
        assert not daily_country_ranking(spark, a, p, h, day, "amount")
    rows = read_history(spark, h).orderBy("date", "country").collect()
    assert [(str(r.date), r.country, r["sum"]) for r in rows] == [
        ("2024-01-01", "A", 10.0), ("2024-01-01", "B", 10.0), ("2024-01-02", "A", 20.0), ("2024-01-02", "B", 20.0),
    ]
    assert [r.country for r in latest_ranking(read_history(spark, h)).collect()] == ["A", "B"]


def test_keep_positive(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, -1.0), (4, None), (None, 5.0)], "k int, v double")
    assert [r.k for r in keep_positive(df, "v").collect()] == [1]


# --- history ----------------------------------------------------------------


def day_rows(spark, day, value):
    return spark.createDataFrame([("A", value)], "country string, sum double").withColumn("date", F.lit(day).cast("date"))


def test_history(spark, tmp_path):
    path = str(tmp_path / "h")
    append_history(day_rows(spark, "2024-01-01", 1.0), path)
    append_history(day_rows(spark, "2024-01-01", 9.0).unionByName(day_rows(spark, "2024-01-02", 2.0)), path)
    got = {str(r.date): r["sum"] for r in read_history(spark, path).collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-02": 2.0}
    replace_dates(day_rows(spark, "2024-01-02", 5.0), path)
    got = {str(r.date): r["sum"] for r in read_history(spark, path).collect()}
    assert got == {"2024-01-01": 1.0, "2024-01-02": 5.0}
    assert holds_date(read_history(spark, path), "2024-01-02") and not holds_date(read_history(spark, path), "2024-01-03")
    lazy = extend_history(read_history(spark, path), day_rows(spark, "2024-01-03", 3.0).select("date", "sum", "country"))
    assert lazy.count() == 3


def test_union_versions(spark):
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([("x", 2)], "s string, k int")
    assert [tuple(r) for r in union_versions(a, b).orderBy("k").collect()] == [(1, None), (2, "x")]


# --- batching ---------------------------------------------------------------


def greedy(sizes, limit):
    out, batch, total = [], 0, None
    for s in sizes:
        if total is not None and total + s > limit:
            batch, total = batch + 1, 0
        total = (total or 0) + s
        out.append(batch)
    return out


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=15), min_size=1, max_size=8),
    st.integers(1, 120),
    st.integers(-1, 130),
)
def test_chunk_summaries_chain_exactly(chunks, limit, state):
    """Entering with ``state`` bytes gives the closes and bytes of a greedy run over all items."""
    rows = [{"_chunk": i, **_chunk_summary(np.array(c), limit)} for i, c in enumerate(chunks)]
    sizes = [s for c in chunks for s in c]
    total, n, entry = (None if state < 0 else state), 0, []
    for c in chunks:
        entry.append((-1 if total is None else total, n))
        for s in c:
            if total is not None and total + s > limit:
                total, n = 0, n + 1
            total = (total or 0) + s
    assert [(s, f) for _, s, f in _chain(rows, state, 0, limit)] == entry
    closed, left = _pass(_chunk_summary(np.array(sizes), limit), np.array([state]), limit)
    assert (int(closed[0]), int(left[0])) == (n, total)


def test_summaries_stay_short():
    rnd = np.random.default_rng(4)
    for sizes in (rnd.integers(0, 2000, 100_000), np.zeros(100_000, np.int64), np.arange(100_000) % 7):
        assert len(_chunk_summary(sizes, 10_000_000)["closed"]) < 5000


def test_summaries_of_a_limit_of_many_items():
    """A limit of five million items: a light chunk is a run or two, what is shuffled takes a few bytes for each item, and the combined summary is exact."""
    rnd = np.random.default_rng(5)
    chunks = [rnd.integers(0, 7, 100_000) for _ in range(64)]
    limit = 5_000_000 * 3
    rows = [_chunk_summary(c, limit) for c in chunks]
    whole = batching._combine([batching._combine(rows[i : i + 16], limit) for i in range(0, 64, 16)], limit)
    assert all(len(r["closed"]) <= 2 and sum(map(len, batching._to_row(r)[1:])) < 200_000 for r in rows)
    assert sum(map(len, batching._to_row(whole)[1:])) < 5_000_000 * 3
    sizes = np.concatenate(chunks)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    for state in (-1, 0, 1, 7_654_321, limit, limit + 5):
        closed, at = 0, 0
        if state >= 0:
            closed, at = 1, int(max(np.searchsorted(sums, limit - state, side="right") - 1, 0))
        while (end := int(np.searchsorted(sums, sums[at] + limit, side="right") - 1)) < len(sizes):
            closed, at = closed + 1, end
        total = sums[-1] - sums[at]
        got = _pass(whole, np.array([state]), limit)
        assert (int(got[0][0]), int(got[1][0])) == (closed, total)


def test_assign_batches(spark, monkeypatch):
    rnd = random.Random(5)
    rows = []
    for g in "ab":
        rows += [(g, i, rnd.choice([0, 3, 10, 55, 120, 7])) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i long, size long").repartition(5)
    want = {}
    for g in "ab":
        for (_, i, _), b in zip([r for r in rows if r[0] == g], greedy([r[2] for r in rows if r[0] == g], 100)):
            want[g, i] = b
    for chunk in (1, 7, 1000):
        monkeypatch.setattr(batching, "_CHUNK_ROWS", chunk)
        got = assign_batches(df, "size", 100, "i", by=["g"]).collect()
        assert {(r.g, r.i): r.batch_no for r in got} == want
    one = assign_batches(df.where("g = 'a'").withColumn("more", F.lit("x")), "size", 100, ["i"])
    assert one.columns == ["g", "i", "size", "more", "batch_no"]
    assert {("a", r.i): r.batch_no for r in one.collect()} == {k: v for k, v in want.items() if k[0] == "a"}
    assert assign_batches(df.where("false"), "size", 100, "i").count() == 0


def test_batches_of_one_day_with_many_empty_items(spark, monkeypatch):
    """Nothing but the order tells the items apart, and most of them weigh nothing."""
    monkeypatch.setattr(batching, "_CHUNK_ROWS", 500)
    sizes = [60 if i % 97 == 0 else 0 for i in range(20_000)]
    df = spark.createDataFrame([(0, i, s) for i, s in enumerate(sizes)], "day int, i long, size long").repartition(7)
    got = {r.i: r.batch_no for r in assign_batches(df, "size", 100, "i", by=["day"]).collect()}
    assert [got[i] for i in range(len(sizes))] == greedy(sizes, 100)


# --- listing and resume -----------------------------------------------------


def test_names(spark):
    names = ["s3://b/k/iot_poc.1700000000000.gz", "iot_poc.5", "iot_poc.x.gz", "a.1.gz.tmp", "b/c.99999999999999999999.gz"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    rows = df.select(name_millis(F.col("path")).alias("t"), name_prefix(F.col("path")).alias("p")).collect()
    assert [r.t for r in rows] == [1700000000000, 5, None, None, None]
    assert [r.p for r in rows][:2] == ["iot_poc", "iot_poc"]
    key = df.select(strip_root("path", "s3://b/").alias("k")).first().k
    assert key == "k/iot_poc.1700000000000.gz"
    assert df.limit(1).select(object_uri(F.lit("x"), "s3://b").alias("u")).first().u == "s3://b/x"


def test_select_objects_window_is_open_closed(spark):
    df = spark.createDataFrame([(f"d/p.{t}.gz",) for t in (1, 2, 3, 4)] + [("d/q.3.gz",), ("d/p.txt",)], "path string")
    got = select_objects(df, "p", after=1, before=3, exclude=["p.2.gz"]).collect()
    assert [r.path for r in got] == ["d/p.3.gz"]


def glob_match(pattern, name):
    import fnmatch

    head, _, tail = pattern.partition("{")
    if not tail:
        return fnmatch.fnmatchcase(name, pattern)
    return any(fnmatch.fnmatchcase(name, head + alt) for alt in tail.rstrip("}").split(","))


@settings(max_examples=200, deadline=None)
@given(st.integers(10**12, 2 * 10**13), st.integers(0, 10**11), st.booleans(), st.integers(1, 3 * 10**13))
def test_glob_admits_the_whole_window(low, width, closed, t):
    before = low + width if closed else None
    pattern = millis_glob("p", low, before)
    inside = t > low and (before is None or t <= before)
    if inside:
        assert glob_match(pattern, f"p.{t}.gz")
    assert not closed or t > 10**13 or abs(t - low) < width + 2 * 10**8 or not glob_match(pattern, f"p.{t}.gz")


def test_pending_objects(spark):
    listing = spark.createDataFrame([(f"p.{T0 + d * DAY}.gz", T0 + d * DAY) for d in range(-3, 3)], "path string, file_ts long")
    ledger = listing.where(F.col("file_ts").isin(T0 - 2 * DAY, T0 + DAY))
    assert resume_point(ledger).first().resume_after == T0
    got = {r.path for r in pending_objects(listing, ledger, DAY).collect()}
    assert got == {f"p.{T0 + 2 * DAY}.gz"}
    wide = {r.path for r in pending_objects(listing, ledger, 10 * DAY).collect()}
    assert len(wide) == 4 and {r.path for r in pending_objects(listing, ledger).collect()} == wide  # no age is too old
    fewer = pending_objects(listing, ledger, 10 * DAY, exclude=listing.where(F.col("file_ts") == T0))
    assert fewer.count() == 3
    assert pending_objects(listing, ledger.limit(0)).count() == 6


# --- misc -------------------------------------------------------------------


def test_column_summary(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    rows = {r.column: r for r in column_summary(df, ["l_quantity", "l_tax"]).collect()}
    described = {r.summary: r for r in df.select("l_quantity").describe().collect()}
    assert rows["l_quantity"].n == int(described["count"].l_quantity)
    assert rows["l_quantity"].stddev == pytest.approx(float(described["stddev"].l_quantity))


def test_stage_and_remove(spark, sf):
    df = spark.read.parquet(f"{sf}/nation.parquet")
    kept = stage(df, "t")
    assert kept.count() == 25 and kept.schema == df.schema
    with staged(df, "t") as copy:
        (path,) = {os.path.dirname(f) for f in copy.inputFiles()}
        assert copy.count() == 25
    assert not os.path.exists(path.removeprefix("file://"))


class FakeSession:
    """Just what ``scratch_dir`` reads."""

    def __init__(self, setting=None, of_context=None):
        self.sparkContext = self.conf = self
        self.setting, self.of_context = setting, of_context

    def get(self, key, default=None):
        return {"spark.checkpoint.dir": self.setting, "spark.sql.warehouse.dir": "hdfs://c/tables/"}[key] or default

    def getCheckpointDir(self):
        return self.of_context


def test_scratch_follows_the_session():
    assert scratch_dir(FakeSession("hdfs://c/shared/", "hdfs://c/own"), "x").startswith("hdfs://c/shared/x-")
    assert scratch_dir(FakeSession(None, "hdfs://c/own"), "x").startswith("hdfs://c/own/x-")
    assert scratch_dir(FakeSession(), "x").startswith("hdfs://c/tables/_scratch/x-")
    assert scratch_dir(FakeSession(), "x") != scratch_dir(FakeSession(), "x")


@settings(max_examples=400, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=15), min_size=1, max_size=8),
    st.integers(1, 300),
    st.integers(-1, 330),
)
def test_combined_summaries_equal_one(chunks, limit, state):
    """Neighbouring summaries, combined in two rounds, act as the summary of all their items."""
    rows = [batching._chunk_summary(np.array(c), limit) for c in chunks]
    spans = [batching._combine(rows[i : i + 3], limit) for i in range(0, len(rows), 3)]
    whole = batching._chunk_summary(np.array([s for c in chunks for s in c]), limit)
    got, want = (_pass(x, np.array([state]), limit) for x in (batching._combine(spans, limit), whole))
    assert [int(x[0]) for x in got] == [int(x[0]) for x in want]


def test_no_task_chains_all_summaries(spark, monkeypatch):
    """Light chunks under a large limit: the numbers are greedy, and no task gets more than a span of summaries."""
    monkeypatch.setattr(batching, "_CHUNK_ROWS", 5)
    monkeypatch.setattr(batching, "_SPAN", 3)
    chain = batching._chain
    seen = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def counted(rows, *rest):
        with open(f"{seen}/{os.getpid()}", "a") as f:
            f.write(f"{len(rows)}\n")
        return chain(rows, *rest)

    monkeypatch.setattr(batching, "_chain", counted)
    sizes = [i % 7 for i in range(400)]
    df = spark.createDataFrame(list(enumerate(sizes)), "i long, size long").coalesce(1)
    got = {r.i: r.batch_no for r in batching.assign_batches(df, "size", 300, "i").collect()}
    assert [got[i] for i in range(400)] == greedy(sizes, 300)
    counts = [int(x) for name in os.listdir(seen) for x in open(f"{seen}/{name}")]
    assert counts and max(counts) <= 3
