"""Session building: configuration from a dict and from ``SPARK_*`` variables."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffle partitions at run time and splits hot ones,
# so no partition count is fixed here: a cluster sets its own upper bound.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a task of a date-partitioned write sees a few dates: keep their files open, do not sort
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

DELTA = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def conf_from_env(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """``SPARK_A_B=v`` becomes ``spark.a.b=v``.

    The rule lower-cases everything, so camel-case keys cannot be reached this
    way; pass those through ``build_session(conf=...)``.
    """
    env = os.environ if env is None else env
    return {k.lower().replace("_", "."): v for k, v in env.items() if k.startswith("SPARK_")}


def s3a_conf(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    region: str | None = None,
    requester_pays: bool = False,
    path_style: bool = False,
    ssl: bool | None = None,
    bucket: str | None = None,
) -> dict[str, str]:
    """Hadoop S3A settings for all object stores, or for one ``bucket`` only; unset arguments leave Hadoop's default.

    Source and target in different stores take a call for each bucket, the dicts merged.
    """
    p = "spark.hadoop.fs.s3a." + (f"bucket.{bucket}." if bucket else "")
    conf = {
        p + "endpoint": endpoint,
        p + "access.key": access_key,
        p + "secret.key": secret_key,
        p + "endpoint.region": region,
        p + "requester.pays.enabled": "true" if requester_pays else None,
        p + "path.style.access": "true" if path_style else None,
        p + "connection.ssl.enabled": None if ssl is None else str(ssl).lower(),
    }
    return {k: v for k, v in conf.items() if v is not None}


def build_session(
    app_name: str = "lakewright",
    conf: Mapping[str, str] | None = None,
    env: Mapping[str, str] | None = None,
    delta: bool = False,
) -> SparkSession:
    """Defaults, then the environment, then ``conf``: the later one wins."""
    merged = {**DEFAULTS, **(DELTA if delta else {}), **conf_from_env(env), **(conf or {})}
    builder = SparkSession.builder.appName(app_name)
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
