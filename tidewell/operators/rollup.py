"""Usage fact: six-hour roll-up, key resolution and the declared grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.calendar import time_key
from tidewell.functions.rating import SMS_EVENT, VOICE_EVENTS

# What a fact row gets when a lookup finds nothing, and the channel of every loaded event.
UNKNOWN_CUSTOMER = -1
DEFAULT_TARIFF = 2001
LOADED_CHANNEL = 1

ROLLUP_KEYS = ["contract_id", "time_key", "event_key", "location_id"]
GRAIN = ["customer_key", "time_key", "tariff_key", "event_key", "channel_key", "location_key"]
COUNTS = ("call_count", "sms_count", "total_call_duration_sec", "event_count")
AMOUNTS = ("total_data_volume_mb", "revenue_amount", "roaming_revenue", "international_revenue", "discount_amount")
MEASURES = [
    "call_count",
    "sms_count",
    "total_call_duration_sec",
    "total_data_volume_mb",
    "revenue_amount",
    "roaming_revenue",
    "international_revenue",
    "discount_amount",
    "fraud_score",
    "event_count",
]


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def usage_rollup(valid: DataFrame) -> DataFrame:
    """Additive measures per contract, six-hour bucket, event and location.

    Rows without a location have no group and are left out, as the load audit reports. All aggregates combine
    before the shuffle, so a contract with a large share of the events costs one row per task and group.
    """
    rows = valid.where("location_id is not null").withColumn("time_key", time_key(F.col("event_datetime")))
    return rows.groupBy(*ROLLUP_KEYS).agg(
        F.count_if(F.col("event_key").isin(*VOICE_EVENTS)).alias("call_count"),
        F.count_if(F.col("event_key") == SMS_EVENT).alias("sms_count"),
        _total("duration_sec").cast("bigint").alias("total_call_duration_sec"),
        _total("data_volume_mb").cast("decimal(18,2)").alias("total_data_volume_mb"),
        _total("cost").cast("decimal(18,2)").alias("revenue_amount"),
        F.max("fraud_score").alias("fraud_score"),
        F.count("cdr_id").alias("event_count"),
    )


def resolve_keys(rolled: DataFrame, contract: DataFrame, customers: DataFrame) -> DataFrame:
    """Replace the contract by tariff and current customer version, with defaults for unmatched rows."""
    terms = contract.select("contract_id", "tariff_id", "customer_id")
    current = customers.where("is_current").select("customer_id", "customer_key")
    return _with_constants(rolled.join(terms, "contract_id", "left").join(current, "customer_id", "left"))


def resolve_keys_at_event(rolled: DataFrame, contract: DataFrame, customers: DataFrame) -> DataFrame:
    """As :func:`resolve_keys`, but with the customer version that was valid on the day of the event."""
    terms = contract.select("contract_id", "tariff_id", "customer_id")
    versions = customers.select(
        F.col("customer_id").alias("_entity"), "customer_key", "effective_from", F.col("effective_to").alias("_until")
    )
    day = F.to_date(F.floor(F.col("time_key") / 100).cast("string"), "yyyyMMdd")
    valid_then = (F.col("customer_id") == F.col("_entity")) & F.col("_day").between(
        F.col("effective_from"), F.coalesce("_until", F.lit("9999-12-31").cast("date"))
    )
    dated = rolled.join(terms, "contract_id", "left").withColumn("_day", day)
    return _with_constants(dated.join(versions, valid_then, "left"))


def _with_constants(resolved: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("decimal(18,2)")
    return resolved.select(
        F.coalesce("customer_key", F.lit(UNKNOWN_CUSTOMER)).cast("bigint").alias("customer_key"),
        "time_key",
        F.coalesce("tariff_id", F.lit(DEFAULT_TARIFF)).cast("int").alias("tariff_key"),
        "event_key",
        F.lit(LOADED_CHANNEL).alias("channel_key"),
        F.col("location_id").alias("location_key"),
        "call_count",
        "sms_count",
        "total_call_duration_sec",
        "total_data_volume_mb",
        "revenue_amount",
        zero.alias("roaming_revenue"),
        zero.alias("international_revenue"),
        zero.alias("discount_amount"),
        "fraud_score",
        "event_count",
        "contract_id",
    )


def at_declared_grain(fact: DataFrame) -> DataFrame:
    """One row per six-key grain, merging contracts of one customer on one tariff."""
    return fact.groupBy(*GRAIN).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in COUNTS],
        *[F.sum(c).cast("decimal(18,2)").alias(c) for c in AMOUNTS],
        F.max("fraud_score").alias("fraud_score"),
    ).select(*GRAIN, *MEASURES)


def load_audit(validated: DataFrame, fact: DataFrame, run_id: str) -> DataFrame:
    """One row per run: extracted, valid, rejected, rows without location and fact rows."""
    lines = validated.select(
        F.lit(0).alias("fact_rows"),
        F.lit(1).alias("extracted"),
        (F.col("etl_status") == "VALID").cast("int").alias("valid"),
        ((F.col("etl_status") == "VALID") & F.col("location_id").isNull()).cast("int").alias("valid_without_location"),
    ).unionByName(
        fact.select(F.lit(1).alias("fact_rows"), *[F.lit(0).alias(c) for c in ("extracted", "valid", "valid_without_location")])
    )
    total = {c: F.coalesce(F.sum(c), F.lit(0)) for c in lines.columns}
    return lines.agg(
        F.lit(run_id).alias("run_id"),
        total["extracted"].alias("extracted"),
        total["valid"].alias("valid"),
        (total["extracted"] - total["valid"]).alias("rejected"),
        total["valid_without_location"].alias("valid_without_location"),
        total["fact_rows"].alias("fact_rows"),
    )
