"""Properties of the physical plans."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lakewright.operators.ranking import share_by_group
from lakewright.plans.catalog import QUERIES

WRITES = {"proto_ingest_bronze", "ingest_late_file", "ingest_pending_batch", "ingest_pending_old", "ingest_cursor_source", "ingest_mirrored_sources", "ingest_large_objects", "ingest_quarantine", "ingest_old_mtime", "ingest_object_ledger", "framed_oversize", "framed_records_roundtrip", "stream_sql_job", "stream_join_sql_job", "gold_incremental",
          "stream_restart_no_duplicates", "batch_sql_job", "schema_evolution_merge", "idempotent_history_append"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_pairwise_joins_or_row_udfs(spark, sf, name):
    plan = plan_of(queries()[name](spark, sf))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(queries()["partition_filter_limit"](spark, sf))
    assert "GreaterThanOrEqual(ts,2024-01-10" in plan and "LessThan(ts,2024-01-11" in plan
    assert "TakeOrderedAndProject" in plan and "props" not in plan.split("ReadSchema:")[1]
    plan = plan_of(queries()["partitioned_day"](spark, sf))
    filters = plan.split("PartitionFilters:")[1].split("]")[0]
    assert "date#" in filters and "= 2024-01-10" in filters and "props" not in plan.split("ReadSchema:")[1]
    plan = plan_of(queries()["string_contains_filter"](spark, sf))
    assert "StringContains(p_name,ring)" in plan
    plan = plan_of(queries()["column_summary"](spark, sf))
    read = plan.split("ReadSchema:")[1]
    assert "l_tax" in read and "l_shipdate" not in read


def test_ranking_orders_a_limited_result_without_a_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan_of(queries()["top_k_groups"](spark, sf))


def test_total_reuses_the_grouped_shuffle(spark, sf):
    df = share_by_group(spark.read.parquet(f"{sf}/lineitem.parquet"), "l_suppkey", "l_orderkey")
    df.collect()
    plan = plan_of(df)
    assert "ReusedExchange" in plan and "Window" not in plan


def test_latest_by_entity_combines_before_the_shuffle(spark, sf):
    plan = plan_of(queries()["latest_by_entity"](spark, sf))
    assert plan.count("partial_max") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_base58_stays_off_the_scan_side_of_filters(spark, sf):
    df = queries()["silver_projection"](spark, sf).where(F.col("date") == "1998-10-03")
    plan = plan_of(df)
    assert plan.index("ArrowEvalPython") < plan.index("Filter")  # filtered first, then encoded
