"""Silver projections of two reward networks and the gold tables over them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions import b58encode_checked

ACTIVE_DAYS = 62  # how far the gold table looks back


def project_rewards(df: DataFrame, entity_key: Column, columns: Mapping[str, str]) -> DataFrame:
    """``date, start_period, end_period, entity_key`` and the named (nested) columns."""
    return df.select(
        "date",
        "start_period",
        "end_period",
        entity_key.alias("entity_key"),
        *(F.col(path).alias(name) for name, path in columns.items()),
    )


def first_set_key(*paths: str) -> Column:
    """The first binary key that is set. Ingest writes unset keys as empty bytes, so empty
    counts as unset."""
    return F.coalesce(*(F.nullif(F.col(p), F.unhex(F.lit(""))) for p in paths))


def iot_rewards(share: DataFrame) -> DataFrame:
    """Silver projection of the IoT reward shares."""
    return project_rewards(
        share,
        b58encode_checked("gateway_reward.hotspot_key"),
        {
            "beacon_amount": "gateway_reward.beacon_amount",
            "witness_amount": "gateway_reward.witness_amount",
            "dc_transfer_amount": "gateway_reward.dc_transfer_amount",
        },
    )


def mobile_rewards(share: DataFrame) -> DataFrame:
    """Silver projection of the mobile reward shares; the key is that of whichever reward is set."""
    return project_rewards(
        share,
        b58encode_checked(first_set_key("radio_reward.hotspot_key", "gateway_reward.hotspot_key")),
        {
            "dc_transfer_amount": "gateway_reward.dc_transfer_reward",
            "poc_amount": "radio_reward.poc_reward",
            "coverage_points": "radio_reward.coverage_points",
            "cbsd_id": "radio_reward.cbsd_id",
        },
    )


def any_positive(amounts: Sequence[str]) -> Column:
    positive = F.lit(False)
    for amount in amounts:
        positive |= F.col(amount) > 0
    return positive


def active_in_network(
    df: DataFrame,
    network: str,
    amounts: Sequence[str],
    as_of: dt.date | None = None,
    days: int = ACTIVE_DAYS,
) -> DataFrame:
    """``most_recent_ts, entity_key, sub_dao`` of the entities with any positive amount lately."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return (
        df.where((F.col("date") >= F.date_sub(day, days)) & any_positive(amounts))
        .groupBy("entity_key")
        .agg(F.max("end_period").alias("most_recent_ts"))
        .select("most_recent_ts", "entity_key", F.lit(network).alias("sub_dao"))
    )


def active_entities(
    iot: DataFrame, mobile: DataFrame, as_of: dt.date | None = None, days: int = ACTIVE_DAYS
) -> DataFrame:
    """Gold table: recently active entities of both networks, one row per entity and network."""
    return active_in_network(
        iot, "iot", ["beacon_amount", "witness_amount", "dc_transfer_amount"], as_of, days
    ).unionByName(active_in_network(mobile, "mobile", ["poc_amount", "dc_transfer_amount"], as_of, days))


def latest_by_key(df: DataFrame, key: str, ts: str, name: str) -> DataFrame:
    """``most_recent_ts`` per entity, with the Base58Check text of its binary key.

    Groups on the raw bytes and encodes once per group; the encoding is one-to-one,
    so the groups are the same.
    """
    return (
        df.groupBy(F.col(key).alias("_key"))
        .agg(F.max(ts).alias("most_recent_ts"))
        .select("most_recent_ts", b58encode_checked("_key").alias(name))
    )
