"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare
from lakewright.plans.catalog import QUERIES


def test_registry():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 30


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, name):
    assert name in oracle_sql()
    assert compare(spark, sf, [name]) == []


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["country", "total", "percent"] and df.count() > 0


def test_mixed_summary_grows(spark, sf):
    """Some query sums up a table with text, numbers, dates and nulls that has more rows at larger scale."""
    got = {r.column_name: r for r in queries()["column_summary_mixed_orders"](spark, sf).collect()}
    n = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert set(got) == set(spark.read.parquet(f"{sf}/orders.parquet").columns) and n > 25
    assert got["o_orderdate"].n == n > got["o_orderpriority"].n > 0
    assert got["o_totalprice"].mean is not None and got["o_orderstatus"].mean is None
