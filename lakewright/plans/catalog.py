"""The registered queries: every operator on the given tables, with its SQL where SQL can say it."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

import pandas as pd
from google.protobuf import message_factory
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.functions import b58encode, b58encode_checked, epoch_day, from_epoch_millis, path_or_null
from lakewright.functions.epoch import MILLIS_PER_DAY
from lakewright.operators.batching import assign_batches
from lakewright.operators.history import append_history, extend_history
from lakewright.operators.outliers import keep_positive, trim_above_group_quantile, trim_above_quantile
from lakewright.operators.quantile import narrowed_quantile
from lakewright.operators.ranking import rank_order, top_groups
from lakewright.operators.resume import pending_objects, resume_point
from lakewright.operators.sketches import merge_sketches, rank_error, sketched_quantiles, value_sketches
from lakewright.operators.summary import column_summary as summarise
from lakewright.operators.summary import column_summary_mixed as summarise_mixed
from lakewright.plans.country_ranking import ranked_share
from lakewright.plans.rewards import active_entities, iot_rewards, latest_by_key, mobile_rewards
from lakewright.plans.sample_messages import KINDS, event_report_format
from lakewright.plans.sql_job import run_sql_job
from lakewright.scratch import remove, scratch_dir, stage
from lakewright.sources.exports import frame_object, set_modified, write_groups
from lakewright.sources.framing import read_records
from lakewright.sources.listing import object_uri, read_objects, select_objects, strip_root
from lakewright.sources.schema_history import record_schema
from lakewright.sources.tables import overwrite_table, read_table, register_tables
from lakewright.streaming.gold import maintain_latest, read_active
from lakewright.streaming.ingest import ingest_objects, ingest_pending, read_bronze, read_ledger, read_rejects

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    """Register a function under its name, with equivalent SQL if there is any."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _millis(ts: str) -> Column:
    """Epoch millis of a zoneless timestamp column, read as UTC."""
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _key8(number: str | Column) -> Column:
    """A number as eight big-endian bytes."""
    return F.unhex(F.lpad(F.hex(number), 16, "0"))


def _cents(column: str) -> Column:
    """A two-decimal amount as whole cents: sums are exact and do not depend on the order."""
    return F.floor(F.col(column) * 100 + 0.5)


def _base58_sql(ids: str, checked: bool) -> str:
    """CTEs ending in ``b58(id, txt)``: Base58(Check) of each id as eight big-endian bytes."""
    body = "'00'||lpad(lower(hex(id)),16,'0')" if checked else "lpad(lower(hex(id)),16,'0')"
    full = "h||left(sha256(unhex(sha256(unhex(h)))),8)" if checked else "h"
    return f"""
      p as (select id, {body} h from ({ids})),
      q as (select id, {full} f from p),
      n as (select id, f, ('0x'||f)::hugeint v from q),
      e as (select id, f, v, '' s from n union all
            select id, f, v//58,
              substr('123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz',(v%58)::int+1,1)||s
            from e where v>0),
      b58 as (select id, repeat('1', ((len(f)-len(ltrim(f,'0')))//2)::bigint)||s txt from e where v=0)"""


# --- ranking ----------------------------------------------------------------

_LOCATED_SQL = """located as (
    select n_name country, cast(l_extendedprice as decimal(18,2)) amount
    from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
    where l_extendedprice > 0),
  cut as (select quantile_cont(cast(amount as double), 0.999) c from located),
  sums as (select country, sum(amount) s from located, cut where cast(amount as double) < c group by country),
  shares as (select country, cast(s as double) as total,
    round(cast(s * 100 as double) / cast(sum(s) over () as double), 6) as percent from sums)"""


def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("gateway"), _cents("l_extendedprice").alias("amount")
    )
    places = (
        _table(spark, sf_dir, "supplier")
        .join(_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("gateway"), F.col("n_name").alias("country"))
    )
    return ranked_share(amounts, places)


def _as_doubles(shares: DataFrame) -> DataFrame:
    return shares.select("country", (F.col("sum") / 100).alias("total"), F.round("percent", 6).alias("percent"))


@_query(f"with {_LOCATED_SQL} select country, total, percent from shares order by total desc, country")
def ranked_share_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(rank_order(_shares(spark, sf_dir), "country"))


@_query(f"with {_LOCATED_SQL} select country, total, percent from shares order by total desc, country limit 5")
def top_k_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_doubles(top_groups(_shares(spark, sf_dir), "country", 5))


_TRIM_SQL = """with cut as (select quantile_cont(l_extendedprice, 0.999) c from lineitem)
  select l_returnflag, l_linestatus, count(*) as n, max(l_extendedprice) as max_price,
         cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total
  from lineitem, cut where l_extendedprice < c group by l_returnflag, l_linestatus"""


def _trimmed(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    prices = _table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    return (
        trim_above_quantile(prices, "l_extendedprice", 0.999, method)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("n"),
            F.max("l_extendedprice").alias("max_price"),
            (F.sum(_cents("l_extendedprice")) / 100).alias("total"),
        )
    )


@_query(_TRIM_SQL)
def outlier_trim_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trimmed(spark, sf_dir, "narrow")


@_query(_TRIM_SQL)
def outlier_trim_by_narrowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trimmed(spark, sf_dir, "narrow")


@_query(
    """with prices as (
      select 'day' as kind, cast(cast(l_shipdate as date) as varchar) as name, l_extendedprice as price from lineitem
      union all
      select 'country', n_name, l_extendedprice
      from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey),
    cuts as (select kind, name, quantile_cont(price, 0.999) as cut from prices group by kind, name)
    select kind, name, count(*) as n, max(price) as max_price, cast(sum(cast(price as decimal(18,2))) as double) as total
    from prices join cuts using (kind, name) where price < cut group by kind, name"""
)
def daily_outlier_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each day and of each country below its own exact p99.9; all cuts are found in the same passes."""
    lines = _table(spark, sf_dir, "lineitem")
    located = lines.join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    located = located.join(_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    price = F.col("l_extendedprice").alias("price")
    days = lines.select(F.lit("day").alias("kind"), F.col("l_shipdate").cast("date").cast("string").alias("name"), price)
    prices = stage(days.unionByName(located.select(F.lit("country").alias("kind"), F.col("n_name").alias("name"), price)), "prices")
    return (
        trim_above_group_quantile(prices, ["kind", "name"], "price", 0.999)
        .groupBy("kind", "name")
        .agg(F.count("*").alias("n"), F.max("price").alias("max_price"), (F.sum(_cents("price")) / 100).alias("total"))
    )


@_query(
    """with prices as (select strftime(cast(l_shipdate as date), '%Y') as span, l_extendedprice as price from lineitem
      union all select 'all', l_extendedprice from lineitem)
    select span, q, count(price) as n, min(price) as low, max(price) as high, true as within
    from prices, (select unnest([0.0, 0.01, 0.5, 0.9, 0.999, 1.0]::double[]) as q) group by span, q"""
)
def quantile_over_stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored per month, in two deliveries, answer for each year and for all; ``within``: the true rank is as near as promised.

    Three times the bound of 99 in 100 is allowed, so that no run fails by chance.
    """
    path = scratch_dir(spark, "sketches")
    day = F.col("l_shipdate").cast("date")
    prices = _table(spark, sf_dir, "lineitem").select(F.trunc(day, "month").alias("date"), "l_extendedprice")
    for delivered in (F.col("date") < "1995-01-01", F.lit(True)):  # the second leaves out the months that are stored
        append_history(value_sketches(prices.where(delivered), ["date"], "l_extendedprice"), path)
    years = merge_sketches(spark.read.parquet(path).withColumn("span", F.date_format("date", "yyyy")), ["span"])
    found = years.unionByName(merge_sketches(years).withColumn("span", F.lit("all")))
    values = sketched_quantiles(found, [0.0, 0.01, 0.5, 0.9, 0.999, 1.0]).drop("sketch")
    spans = prices.select(F.explode(F.array(F.date_format("date", "yyyy"), F.lit("all"))).alias("span"), "l_extendedprice")
    below, upto = F.col("l_extendedprice") < F.col("value"), F.col("l_extendedprice") <= F.col("value")
    ranked = spans.join(values, "span").groupBy("span", "q", "n", "low", "high")
    ranked = ranked.agg((F.sum(below.cast("long")) / F.col("n")).alias("first"), (F.sum(upto.cast("long")) / F.col("n")).alias("last"))
    error = 3 * rank_error()
    within = (F.col("first") <= F.col("q") + error) & (F.col("q") <= F.col("last") + error)
    return ranked.select("span", "q", "n", "low", "high", within.alias("within"))


_EXTREME_SQL = """case event_id % 50 when 0 then null when 1 then 'Infinity'::double when 2 then '-Infinity'::double
  when 3 then 'NaN'::double else value end"""


@_query(
    f"""with v as (select {_EXTREME_SQL} x from events),
      s as (select list(x order by x) filter (x is not null) xs from v),
      q as (select unnest([0.0, 0.01, 0.25, 0.5, 0.97, 1.0]::double[]) q),
      p as (select q, xs, q * (len(xs) - 1) pos, floor(q * (len(xs) - 1))::bigint r from q, s)
      select q, case when pos = r or xs[r + 1] = xs[r + 2] then xs[r + 1]
        else (r + 1 - pos) * xs[r + 1] + (pos - r) * xs[r + 2] end as value from p
      union all select -1.0::double, min(value) from events where event_id = 4"""
)
def quantile_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of values with nulls, both infinities and NaN, and of a single row."""
    events = _table(spark, sf_dir, "events")
    at = F.col("event_id") % 50
    odd = F.when(at == 0, None).when(at == 1, float("inf")).when(at == 2, float("-inf")).when(at == 3, float("nan"))
    values = events.select(odd.otherwise(F.col("value")).cast("double").alias("x"))
    rows = [(q, narrowed_quantile(values, "x", q)) for q in (0.0, 0.01, 0.25, 0.5, 0.97, 1.0)]
    rows.append((-1.0, narrowed_quantile(events.where("event_id = 4"), "value", 0.5)))
    return spark.createDataFrame(rows, "q double, value double")


@_query(
    """select c_custkey, c_name, c_mktsegment, balance
       from (select *, case when c_acctbal > 0 then c_acctbal end as balance from customer)
       where balance is not null and c_custkey is not null and c_name is not null and c_mktsegment is not null"""
)
def conditional_null_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return keep_positive(customers, "c_acctbal").withColumnRenamed("c_acctbal", "balance")


_SUMMARY_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@_query(
    " union all ".join(
        f"""select '{c}' as column_name, count({c}) as n, round(avg({c}), 4) as mean,
            round(stddev_samp({c}), 4) as stddev, min({c}) as min_value, max({c}) as max_value from lineitem"""
        for c in _SUMMARY_COLUMNS
    )
)
def column_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(_table(spark, sf_dir, "lineitem"), _SUMMARY_COLUMNS).select(
        F.col("column").alias("column_name"),
        "n",
        F.round("mean", 4).alias("mean"),
        F.round("stddev", 4).alias("stddev"),
        F.col("min").alias("min_value"),
        F.col("max").alias("max_value"),
    )


_MIXED = {"n_nationkey": True, "n_name": False, "n_regionkey": True}


@_query(
    " union all ".join(
        f"""select '{c}' as column_name, count({c}) as n, {f"round(avg({c}), 4)" if number else "null::double"} as mean,
            {f"round(stddev_samp({c}), 4)" if number else "null::double"} as stddev,
            min({c})::varchar as min_value, max({c})::varchar as max_value from nation"""
        for c, number in _MIXED.items()
    )
)
def column_summary_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and text together, each extreme as text."""
    return summarise_mixed(_table(spark, sf_dir, "nation")).select(
        F.col("column").alias("column_name"), "n", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
        F.col("min").alias("min_value"), F.col("max").alias("max_value"),
    )


_MIXED_ORDERS = {
    "o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": True, "o_orderdate": False, "o_orderpriority": False,
}


@_query(
    " union all ".join(
        f"""select '{c}' as column_name, count({c}) as n, {f"round(avg({c}), 4)" if number else "null::double"} as mean,
            {f"round(stddev_samp({c}), 4)" if number else "null::double"} as stddev,
            min({c})::varchar as min_value, max({c})::varchar as max_value
            from (select * replace (case when o_orderkey % 11 <> 0 then o_orderpriority end as o_orderpriority) from orders)"""
        for c, number in _MIXED_ORDERS.items()
    )
)
def column_summary_mixed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, text and dates of a table that grows, one column with nulls."""
    priority = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority"))
    return summarise_mixed(_table(spark, sf_dir, "orders").withColumn("o_orderpriority", priority)).select(
        F.col("column").alias("column_name"), "n", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
        F.col("min").alias("min_value"), F.col("max").alias("max_value"),
    )


# --- rewards ----------------------------------------------------------------


@_query(
    f"""with recursive {_base58_sql("select distinct o_custkey id from orders", True)}
    select max(epoch_ms(o_orderdate)) as most_recent_ts, any_value(txt) as entity_key
    from orders join b58 on o_custkey = id group by o_custkey"""
)
def latest_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        _key8("o_custkey").alias("hotspot_key"), _millis("o_orderdate").alias("end_period")
    )
    return latest_by_key(orders, "hotspot_key", "end_period", "entity_key")


AS_OF = dt.date(2001, 8, 1)


_ACTIVE_SQL = """select max(epoch_ms(l_shipdate)) as most_recent_ts, cast(l_suppkey as varchar) as entity_key, 'iot' as sub_dao
       from lineitem where cast(l_shipdate as date) >= date '2001-08-01' - 62
         and (l_quantity > 0 or l_tax > 0 or l_discount > 0) group by l_suppkey
       union all
       select max(epoch_ms(o_orderdate)), cast(o_custkey as varchar), 'mobile'
       from orders where cast(o_orderdate as date) >= date '2001-08-01' - 62 and o_totalprice > 0 group by o_custkey"""


def _silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The dated rewards of both networks."""
    iot = _table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        _millis("l_shipdate").alias("end_period"),
        F.col("l_suppkey").cast("string").alias("entity_key"),
        F.col("l_quantity").alias("beacon_amount"),
        F.col("l_tax").alias("witness_amount"),
        F.col("l_discount").alias("dc_transfer_amount"),
    )
    mobile = _table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        _millis("o_orderdate").alias("end_period"),
        F.col("o_custkey").cast("string").alias("entity_key"),
        F.col("o_totalprice").alias("poc_amount"),
        F.lit(0.0).alias("dc_transfer_amount"),
    )
    return iot, mobile


@_query(_ACTIVE_SQL)
def active_entities_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_entities(*_silver(spark, sf_dir), AS_OF)


@_query(_ACTIVE_SQL)
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from tables that a stream keeps up: rows arrive in three parts, and the last micro-batch is run twice."""
    found = []
    amounts = {"iot": ["beacon_amount", "witness_amount", "dc_transfer_amount"], "mobile": ["poc_amount", "dc_transfer_amount"]}
    for (network, of), silver in zip(amounts.items(), _silver(spark, sf_dir)):
        source, target, checkpoint = (scratch_dir(spark, name) for name in ("silver", "gold", "gold-checkpoint"))
        third = F.pmod(F.xxhash64("entity_key", "end_period"), F.lit(3))
        for part in range(3):
            silver.where(third == part).write.mode("append").parquet(source)
            stream = spark.readStream.schema(silver.schema).parquet(source)
            maintain_latest(stream, target, checkpoint, of).awaitTermination()
        remove(spark, f"{checkpoint}/commits/2")  # as if the run had ended between the table's commit and the stream's
        maintain_latest(spark.readStream.schema(silver.schema).parquet(source), target, checkpoint, of).awaitTermination()
        found.append(read_active(spark, target, network, AS_OF))
    return found[0].unionByName(found[1])


@_query(
    f"""with recursive {_base58_sql("select distinct o_custkey id from orders", True)}
    select cast(o_orderdate as date) as date, epoch_ms(o_orderdate) as start_period,
      epoch_ms(o_orderdate) + 86400000 as end_period, txt as entity_key, o_totalprice as beacon_amount,
      o_orderkey as witness_amount, o_orderpriority as dc_transfer_amount
    from orders join b58 on o_custkey = id"""
)
def silver_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = _millis("o_orderdate")
    share = _table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        millis.alias("start_period"),
        (millis + 86_400_000).alias("end_period"),
        F.struct(
            _key8("o_custkey").alias("hotspot_key"),
            F.col("o_totalprice").alias("beacon_amount"),
            F.col("o_orderkey").alias("witness_amount"),
            F.col("o_orderpriority").alias("dc_transfer_amount"),
        ).alias("gateway_reward"),
    )
    return iot_rewards(share)


@_query(
    f"""with recursive {_base58_sql("select distinct user_id id from events union select event_id from events", True)}
    select cast(ts as date) as date, (epoch_us(ts) // 1000) as start_period, (epoch_us(ts) // 1000) as end_period,
      txt as entity_key, value as dc_transfer_amount, event_id as poc_amount, user_id as coverage_points,
      props as cbsd_id
    from (select *, case when event_type in ('view', 'click') then user_id
                         when event_type <> 'signup' then event_id end as k from events)
    left join b58 on k = id"""
)
def silver_coalesce_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of the first reward that is set; unset keys come as empty bytes."""
    unset = F.unhex(F.lit(""))
    kind = F.col("event_type")
    share = _table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("date"),
        _millis("ts").alias("start_period"),
        _millis("ts").alias("end_period"),
        F.struct(
            F.when(kind.isin("view", "click"), _key8("user_id")).otherwise(unset).alias("hotspot_key"),
            F.col("event_id").alias("poc_reward"),
            F.col("user_id").alias("coverage_points"),
            F.col("props").alias("cbsd_id"),
        ).alias("radio_reward"),
        F.struct(
            F.when(kind != "signup", _key8("event_id")).otherwise(unset).alias("hotspot_key"),
            F.col("value").alias("dc_transfer_reward"),
        ).alias("gateway_reward"),
    )
    return mobile_rewards(share)


# --- exploration and functions ----------------------------------------------


@_query(
    """select event_id, user_id, event_type, value from events
       where cast(ts as date) = date '2024-01-10' order by event_id limit 25"""
)
def partition_filter_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_tables(spark, {"EVENTS": f"{sf_dir}/events.parquet"})
    return spark.sql(
        """select event_id, user_id, event_type, value from events
           where ts >= timestamp_ntz '2024-01-10' and ts < timestamp_ntz '2024-01-11'
           order by event_id limit 25"""
    )


@_query(
    """select event_id, user_id, event_type, value, cast(ts as date) as date from events
       where cast(ts as date) = date '2024-01-10' order by event_id limit 25"""
)
def partitioned_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of a table partitioned by date: only that partition is read."""
    target = scratch_dir(spark, "dated")
    dated = _table(spark, sf_dir, "events").withColumn("date", F.col("ts").cast("date"))
    overwrite_table(dated, target, partition_by=["date"])
    register_tables(spark, {"DATED_EVENTS": target})
    return spark.sql(
        """select event_id, user_id, event_type, value, date from dated_events
           where date = date '2024-01-10' order by event_id limit 25"""
    )


@_query("select * from part where contains(p_name, 'ring')")
def string_contains_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part")
    return parts.select("*").where(F.col("p_name").contains("ring"))


@_query(
    f"""with recursive {_base58_sql("select c_custkey id from customer", False)}
    select id as c_custkey, txt as key_text from b58"""
)
def base58_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select("c_custkey", b58encode(_key8("c_custkey")).alias("key_text"))


@_query(
    f"""with recursive {_base58_sql("select c_custkey id from customer", True)}
    select id as c_custkey, txt as key_text from b58"""
)
def base58check_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select("c_custkey", b58encode_checked(_key8("c_custkey")).alias("key_text"))


@_query(
    """select event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%g') as received_at
       from events"""
)
def epoch_millis_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = _millis("ts").cast("decimal(23,0)")  # the type unsigned 64-bit fields arrive in
    return _table(spark, sf_dir, "events").select(
        "event_id", F.date_format(from_epoch_millis(millis), "yyyy-MM-dd HH:mm:ss.SSS").alias("received_at")
    )


@_query(
    """select event_id, case when event_type = 'error' then date '1970-01-01' else cast(ts as date) end as date,
         cast(ts as date) as date_of_seconds, date '1970-01-01' as date_of_nothing from events"""
)
def epoch_date_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day of a nested epoch in millis (null and a path to nowhere count as day 0) and in seconds."""
    millis = _millis("ts").cast("decimal(23,0)")
    reports = _table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.when(F.col("event_type") != "error", millis).alias("received_timestamp"),
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("start_period"),
        ).alias("report"),
    )
    return reports.select(
        "event_id",
        epoch_day(path_or_null(reports, "report.received_timestamp")).alias("date"),
        epoch_day(path_or_null(reports, "report.start_period"), 86_400).alias("date_of_seconds"),
        epoch_day(path_or_null(reports, "report.sent.timestamp")).alias("date_of_nothing"),
    )


# --- listing, resume, batches -----------------------------------------------

_ROOT = "s3://bucket/raw"


def _listing(events: DataFrame) -> DataFrame:
    """One object per event, named by type and time; sign-ups get a name outside the pattern."""
    millis = F.when(F.col("event_type") == "signup", F.lit("latest")).otherwise(_millis("ts").cast("string"))
    key = F.concat_ws(".", "event_type", millis, F.lit("gz"))
    return events.select(object_uri(key, _ROOT).alias("path"), F.octet_length("props").alias("length"))


_LISTING_SQL = """listing as (
    select 's3://bucket/raw/' || event_type || '.' || (epoch_us(ts) // 1000) || '.gz' as path, (epoch_us(ts) // 1000) as file_ts,
      strlen(props)::int as length, event_type from events where event_type <> 'signup')"""


@_query(
    f"""with {_LISTING_SQL} select path, length, file_ts, replace(path, 's3://bucket/raw/', '') as key
    from listing where event_type = 'view' and file_ts > 1704844800000 and file_ts <= 1705276800000"""
)
def file_listing_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = _listing(_table(spark, sf_dir, "events"))
    found = select_objects(listing, "view", after=1_704_844_800_000, before=1_705_276_800_000)
    return found.select("path", "length", "file_ts", strip_root("path", _ROOT).alias("key"))


@_query(
    f"""with {_LISTING_SQL},
    ledger as (select path, file_ts from listing where event_type <> 'error' and file_ts <= 1705968000000),
    point as (select max(file_ts) last_ts, max(file_ts) - 86400000 resume_after from ledger)
    select path, file_ts, cast(make_timestamp(resume_after * 1000) as date) as resume_date
    from listing, point
    where file_ts > resume_after and path not in (select path from ledger)"""
)
def ingest_resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects still to read when error reports and all later objects have not been read yet."""
    listing = select_objects(_listing(_table(spark, sf_dir, "events")))
    ledger = listing.where(~F.contains("path", F.lit("/error.")) & (F.col("file_ts") <= 1_705_968_000_000))
    after = resume_point(ledger).select("resume_after").scalar()
    return pending_objects(listing.select("path", "file_ts"), ledger, MILLIS_PER_DAY).select(
        "path", "file_ts", from_epoch_millis(after).cast("date").alias("resume_date")
    )


def _greedy_sql(items: str, limit: int) -> str:
    """Batch numbers of ``items(grp, id, rn, size)`` taken one by one in order."""
    return f"""with recursive items as ({items}),
    run as (select grp, id, rn, size, size as total, 0::bigint as batch_no from items where rn = 1
      union all
      select i.grp, i.id, i.rn, i.size,
        case when r.total + i.size > {limit} then i.size else r.total + i.size end,
        case when r.total + i.size > {limit} then r.batch_no + 1 else r.batch_no end
      from run r join items i on i.grp = r.grp and i.rn = r.rn + 1)"""


@_query(
    _greedy_sql(
        "select 0 as grp, page_id as id, row_number() over (order by page_id) rn, strlen(html)::bigint size from pages",
        65_536,
    )
    + " select id as page_id, size, batch_no from run"
)
def size_bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", F.octet_length("html").cast("bigint").alias("size"))
    return assign_batches(pages, "size", 65_536, "page_id")


@_query(
    _greedy_sql(
        """select event_type as grp, event_id as id, row_number() over (partition by event_type order by event_id) rn,
           strlen(props)::bigint size from events""",
        400,
    )
    + " select grp as event_type, id as event_id, size, batch_no from run"
)
def size_bounded_batches_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select(
        "event_type", "event_id", F.octet_length("props").cast("bigint").alias("size")
    )
    return assign_batches(events, "size", 400, "event_id", by=["event_type"])


# --- objects and ingest -----------------------------------------------------

_OBJECT_ROWS = 50_000  # events per written object at most, so no task builds a larger one


def _write_objects(events: DataFrame, columns: list[Column], encode: Callable[[pd.DataFrame], list[bytes]], root: str) -> DataFrame:
    """Writes framed gzip objects of one day's consecutive events, named by their first time; ``path, length``."""

    def build(key: tuple, pdf: pd.DataFrame) -> tuple[str, bytes]:
        pdf = pdf.sort_values("event_id")
        day, number = key
        return f"events-{day}-{number}.{pdf['millis'].min()}.gz", frame_object(encode(pdf))

    day, number = F.floor(F.col("millis") / MILLIS_PER_DAY), F.floor(F.col("event_id") / _OBJECT_ROWS)
    return write_groups(events.select("event_id", _millis("ts").alias("millis"), *columns), [day, number], root, build)


@_query("select event_id, user_id, event_type, value from events")
def framed_records_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as framed text records into gzip objects, and read back."""

    def encode(pdf: pd.DataFrame) -> list[bytes]:
        return [line.encode() for line in pdf["line"]]

    root = scratch_dir(spark, "framed")
    line = F.concat_ws("|", "event_id", "user_id", "event_type", "value").alias("line")
    _write_objects(_table(spark, sf_dir, "events"), [line], encode, root).count()
    parts = F.split(F.decode("record", "UTF-8"), r"\|")
    return (
        read_records(read_objects(spark, root, "events"))
        .where("error is null")
        .select(
            parts[0].cast("bigint").alias("event_id"),
            parts[1].cast("bigint").alias("user_id"),
            parts[2].alias("event_type"),
            parts[3].cast("double").alias("value"),
        )
    )


@_query(
    """select event_id, event_type, octet_length(encode(event_id::varchar || '|' || event_type)) <= 9 as kept
       from events"""
)
def framed_oversize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records above the limit are left out by themselves; all others of their objects are there."""

    def encode(pdf: pd.DataFrame) -> list[bytes]:
        return [line.encode() for line in pdf["line"]]

    root = scratch_dir(spark, "framed")
    events = _table(spark, sf_dir, "events")
    line = F.concat_ws("|", "event_id", "event_type")
    _write_objects(events, [line.alias("line")], encode, root).count()
    found = read_records(read_objects(spark, root, "events"), max_frame=9).where("record is not null")
    kept = found.select(F.decode("record", "UTF-8").alias("line"), F.lit(True).alias("kept"))
    return (
        events.select("event_id", "event_type", line.alias("line"))
        .join(kept, "line", "left")
        .select("event_id", "event_type", F.coalesce("kept", F.lit(False)).alias("kept"))
    )


def _write_reports(events: DataFrame, root: str, spoil: str | None = None) -> DataFrame:
    """Writes events as protobuf report objects; reports of type ``spoil`` are unreadable."""
    fmt = event_report_format()

    def encode(pdf: pd.DataFrame) -> list[bytes]:
        report = message_factory.GetMessageClass(fmt.descriptor())
        out = []
        for r in pdf.itertuples(index=False):
            if r.event_type == spoil:
                out.append(b"\xff\xff")
                continue
            m = report(tags=[r.event_type, r.props], user_key=int(r.user_id).to_bytes(8, "big"))
            m.event.event_id, m.event.received_timestamp, m.event.user_id = r.event_id, r.millis, r.user_id
            m.event.kind, m.event.value = KINDS.index(r.event_type), r.value
            out.append(m.SerializeToString())
        return out

    columns = [F.col(c) for c in ("user_id", "event_type", "value", "props")]
    return _write_objects(events, columns, encode, root)


_REPORTS_SQL = """select event_id, user_id, event_type, value, event_type as first_tag, props as last_tag,
  lpad(lower(hex(user_id)), 16, '0') as user_key, cast(ts as date) as date from events"""


def _reports(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("event.event_id").cast("bigint").alias("event_id"),
        F.col("event.user_id").alias("user_id"),
        F.col("event.kind").alias("event_type"),
        F.col("event.value").alias("value"),
        F.col("tags")[0].alias("first_tag"),
        F.element_at("tags", -1).alias("last_tag"),
        F.lower(F.hex("user_key")).alias("user_key"),
        "date",
    )


def _ingest(spark: SparkSession, root: str, target: str, **options) -> None:
    ingest_objects(
        spark, root, target, target + "-checkpoint", event_report_format(), prefix="events", **options
    ).awaitTermination()


@_query(_REPORTS_SQL)
def proto_ingest_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as protobuf objects and ingested into the dated bronze table."""
    root, target = scratch_dir(spark, "objects"), scratch_dir(spark, "bronze")
    _write_reports(_table(spark, sf_dir, "events"), root).count()
    _ingest(spark, root, target)
    return _reports(read_bronze(spark, target))


@_query(_REPORTS_SQL)
def ingest_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of the first half of the month turn up after those of the second; one run repeats."""
    root, target = scratch_dir(spark, "objects"), scratch_dir(spark, "bronze")
    events = _table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    _write_reports(events.where(~early), root).count()
    _ingest(spark, root, target)
    _write_reports(events.where(early), root).count()
    _ingest(spark, root, target)
    _ingest(spark, root, target)
    return _reports(read_bronze(spark, target))


@_query(_REPORTS_SQL)
def ingest_old_mtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unread objects turn up whose modification time lies a month behind that of what was read."""
    root, target = scratch_dir(spark, "objects"), scratch_dir(spark, "bronze")
    events = _table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    _write_reports(events.where(early), root).count()
    _ingest(spark, root, target)
    late = _write_reports(events.where(~early), root)
    set_modified(spark, [r.path for r in late.collect()], int(time.time() * 1000) - 30 * MILLIS_PER_DAY)
    _ingest(spark, root, target)
    return _reports(read_bronze(spark, target))


@_query(_REPORTS_SQL)
def ingest_pending_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the objects are ingested as a stream; the rest is appended as a batch, twice, the second time in vain."""
    root, target = scratch_dir(spark, "objects"), scratch_dir(spark, "bronze")
    _write_reports(_table(spark, sf_dir, "events"), root).count()
    _ingest(spark, root, target, before=1_705_276_800_000, open_in_tasks=True)
    for _ in range(2):
        ingest_pending(spark, root, target, event_report_format(), prefix="events")
    return _reports(read_bronze(spark, target))


@_query(_REPORTS_SQL)
def ingest_pending_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last days are ingested as a stream; unread objects up to a month older are then taken as a batch that is told nothing."""
    root, target = scratch_dir(spark, "objects"), scratch_dir(spark, "bronze")
    _write_reports(_table(spark, sf_dir, "events"), root).count()
    _ingest(spark, root, target, after=1_706_140_800_000)
    ingest_pending(spark, root, target, event_report_format())
    return _reports(read_bronze(spark, target))


@_query(_REPORTS_SQL)
def ingest_cursor_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects found by a cursor with a look-back of three days: one turns up late within it, the first days too late.

    The stream takes the late one and what is new, a repeat takes nothing, and the ledger finds the rest.
    """
    root, target = scratch_dir(spark, "objects"), scratch_dir(spark, "bronze")
    events, day = _table(spark, sf_dir, "events"), F.floor(_millis("ts") / MILLIS_PER_DAY) - 19_723
    at_first = day.between(10, 17) | (day == 19)
    for arriving, runs in ((at_first, 1), (~at_first, 2)):
        _write_reports(events.where(arriving), root).count()
        for _ in range(runs):
            _ingest(spark, root, target, look_back_millis=3 * MILLIS_PER_DAY)
    ingest_pending(spark, root, target, event_report_format(), prefix="events")
    return _reports(read_bronze(spark, target))


@_query(_REPORTS_SQL)
def ingest_mirrored_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders that share a week of objects; then copies turn up in the other folder, and the first days, too late for the stream.

    Each object is read once: by the stream, which remembers three days of keys, or with the ledger's help.
    """
    root, mirror, target = scratch_dir(spark, "objects"), scratch_dir(spark, "mirror"), scratch_dir(spark, "bronze")
    events, day = _table(spark, sf_dir, "events"), F.floor(_millis("ts") / MILLIS_PER_DAY) - 19_723
    for here, there in (((8, 22), (16, 26)), ((0, 7), (20, 40)), ((23, 27), (5, 9))):
        _write_reports(events.where(day.between(*here)), root).count()
        _write_reports(events.where(day.between(*there)), mirror).count()
        _ingest(spark, root, target, mirrors=[mirror], mirror_delay="3 days")
    for _ in range(2):
        ingest_pending(spark, root, target, event_report_format(), prefix="events", mirrors=[mirror])
    return _reports(read_bronze(spark, target))


@_query(
    f"""select 'events-' || day || '-' || number || '.' || min(millis) || '.gz' as name, count(*) as frames,
          count(*) filter (event_type = 'error') as rejected
        from (select *, epoch_us(ts) // 1000 as millis, epoch_us(ts) // {1000 * MILLIS_PER_DAY} as day, event_id // {_OBJECT_ROWS} as number
              from events)
        group by day, number"""
)
def ingest_object_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames and rejects per object, read half as a stream and half as a batch; objects of rejects only are there too."""
    root, target = scratch_dir(spark, "objects"), scratch_dir(spark, "bronze")
    _write_reports(_table(spark, sf_dir, "events"), root, spoil="error").count()
    _ingest(spark, root, target, before=1_705_276_800_000)
    for _ in range(2):
        ingest_pending(spark, root, target, event_report_format(), prefix="events", look_back_millis=60 * MILLIS_PER_DAY)
    rejects = read_rejects(spark, target).groupBy(F.col("file").alias("path")).agg(F.count("*").alias("rejected"))
    ledger = read_ledger(spark, target).join(rejects, "path", "left")
    return ledger.select(
        F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "frames", F.coalesce("rejected", F.lit(0)).alias("rejected")
    )


@_query(_REPORTS_SQL)
def ingest_large_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of every object above 16 KB are spread over the tasks before they are parsed."""
    root, target = scratch_dir(spark, "objects"), scratch_dir(spark, "bronze")
    _write_reports(_table(spark, sf_dir, "events"), root).count()
    _ingest(spark, root, target, spread_above=16_384)
    return _reports(read_bronze(spark, target))


@_query(
    """select case when event_type = 'error' then 'rejected' else 'accepted' end as outcome, count(*) as n
       from events group by 1"""
)
def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable reports stay out of the table and go to the quarantine, in the same reading."""
    root, target = scratch_dir(spark, "objects"), scratch_dir(spark, "bronze")
    _write_reports(_table(spark, sf_dir, "events"), root, spoil="error").count()
    _ingest(spark, root, target)
    accepted = read_bronze(spark, target).select(F.lit("accepted").alias("outcome"))
    rejected = read_rejects(spark, target).select(F.lit("rejected").alias("outcome"))
    return accepted.unionByName(rejected).groupBy("outcome").agg(F.count("*").alias("n"))


# --- SQL jobs ---------------------------------------------------------------

_SILVER_JOB = """
select cast(ts as date) as date, event_id, event_type, value * 2 as doubled,
  b58encodeChecked(unhex(lpad(hex(user_id), 16, '0'))) as entity_key,
  unix_seconds(from_epoch_millis(unix_millis(cast(ts as timestamp)))) as at_seconds
from event_stream where value > 1
"""

_SILVER_JOB_SQL = f"""with recursive {_base58_sql("select distinct user_id id from events", True)}
  select cast(ts as date) as date, event_id, event_type, value * 2 as doubled, txt as entity_key,
    (epoch_us(ts) // 1000000) as at_seconds
  from events join b58 on user_id = id where value > 1"""


def _stream_job(spark: SparkSession, source: str, target: str) -> None:
    run_sql_job(
        spark,
        _SILVER_JOB,
        {"EVENT_STREAM": source},
        target,
        streaming=True,
        partition_by=["date"],
        checkpoint=target + "-checkpoint",
        trigger="AvailableNow",
    ).awaitTermination()


@_query(_SILVER_JOB_SQL)
def stream_sql_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_dir(spark, "stream")
    _stream_job(spark, f"{sf_dir}/events.parquet", target)
    return spark.read.parquet(target)


@_query(_SILVER_JOB_SQL)
def stream_restart_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source grows between two runs of the job, and a third run finds nothing new."""
    source, target = scratch_dir(spark, "source"), scratch_dir(spark, "stream")
    events = _table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    events.where(early).write.parquet(source)
    _stream_job(spark, source, target)
    events.where(~early).write.mode("append").parquet(source)
    _stream_job(spark, source, target)
    _stream_job(spark, source, target)
    return spark.read.parquet(target)


@_query(
    """select cast(ts as date) as date, event_id, c_mktsegment, value * 2 as doubled
       from events join customer on c_custkey = user_id where event_type = 'purchase'"""
)
def stream_join_sql_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One SQL file over a streaming table and a fixed one; a second run adds nothing."""
    target = scratch_dir(spark, "stream")
    sql = """select cast(ts as date) as date, event_id, c_mktsegment, value * 2 as doubled
             from event_stream join customers on c_custkey = user_id where event_type = 'purchase'"""
    tables = {"EVENT_STREAM": f"{sf_dir}/events.parquet", "CUSTOMERS": f"{sf_dir}/customer.parquet"}
    for _ in range(2):
        run_sql_job(
            spark, sql, tables, target, streaming=["event_stream"], partition_by=["date"],
            checkpoint=target + "-checkpoint", trigger="AvailableNow",
        ).awaitTermination()
    return spark.read.parquet(target)


@_query(
    """select o_orderpriority, cast(o_orderdate as date) as last_date, n, total
       from (select o_orderpriority, max(o_orderdate) o_orderdate, count(*) as n,
               cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
             from orders group by o_orderpriority)"""
)
def batch_sql_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate as a batch overwrite, run twice into the same table."""
    target = scratch_dir(spark, "batch")
    sql = """select o_orderpriority, cast(max(o_orderdate) as date) as last_date, count(*) as n,
               cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
             from all_orders group by o_orderpriority"""
    for _ in range(2):
        run_sql_job(spark, sql, {"ALL_ORDERS": f"{sf_dir}/orders.parquet"}, target)
    return spark.read.parquet(target)


# --- evolution and history --------------------------------------------------


@_query(
    """select event_id, event_type, case when ts >= timestamp '2024-01-15' then props end as props,
         case when ts >= timestamp '2024-01-15' then value end as value from events"""
)
def schema_evolution_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two schema versions appended to one table; the older rows lack the added columns."""
    target = scratch_dir(spark, "evolving")
    events = _table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for version in (
        events.where(early).select("event_id", "event_type"),
        events.where(~early).select("event_type", "event_id", "props", "value"),
    ):
        schema = record_schema(spark, target, version.schema)
        version.select(*schema.fieldNames()).write.mode("append").parquet(target)
    return read_table(spark, target)


_DAILY_SQL = """select event_type, cast(sum(cast(value as decimal(18,2))) as double) as total,
  cast(ts as date) as date from events group by event_type, cast(ts as date)"""


def _daily(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_type", F.col("ts").cast("date").alias("date"))
        .agg((F.sum(_cents("value")) / 100).alias("total"))
        .select("event_type", "total", "date")
    )


@_query(_DAILY_SQL)
def idempotent_history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals appended twice; the second time all days are there and nothing changes."""
    target = scratch_dir(spark, "history")
    daily = _daily(_table(spark, sf_dir, "events"))
    append_history(daily.where("date < date'2024-01-15'"), target)
    for _ in range(2):
        append_history(daily, target)
    return read_table(spark, target)


@_query(_DAILY_SQL)
def history_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as one lazy plan: a history of half the month, extended by all days."""
    daily = _daily(_table(spark, sf_dir, "events"))
    return extend_history(daily.where("date < date'2024-01-15'"), daily)
