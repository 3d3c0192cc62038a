"""The functions under the names SQL files use."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakewright.functions.base58 import _b58

# SQL bodies are inlined by the analyser, so these two add no Python stage of their own.
_SQL_FUNCTIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION b58encodeChecked(k BINARY) RETURNS STRING RETURN
       b58encode(concat(X'00', k,
         substring(unhex(sha2(unhex(sha2(concat(X'00', k), 256)), 256)), 1, 4)))""",
    """CREATE OR REPLACE TEMPORARY FUNCTION from_epoch_millis(ms BIGINT) RETURNS TIMESTAMP
       RETURN timestamp_millis(ms)""",
)


def register_functions(spark: SparkSession) -> None:
    """Make ``b58encode``, ``b58encodeChecked`` and ``from_epoch_millis`` callable from SQL."""
    spark.udf.register("b58encode", _b58)
    for ddl in _SQL_FUNCTIONS:
        spark.sql(ddl)
