"""Analytical marts over the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.measures import mean, money, percent, ratio, rounded, rows, rows_where, whole
from tidewell.functions.rating import rated_amount
from tidewell.operators.intervals import within_validity
from tidewell.plans.checks import REFERENCES, Tables
from tidewell.operators.rules import check_references

HIGH_RISK = 0.6
CRITICAL_RISK = 0.8


def revenue_by_tariff(t: Tables) -> DataFrame:
    plans = t["dim_tariff"].select("tariff_key", "tariff_name", "tariff_type", "operator_name")
    customers = F.countDistinct("customer_key")
    revenue = F.sum("revenue_amount")
    return (
        t["fact_usage_events"]
        .join(plans, "tariff_key")
        .groupBy("tariff_name", "tariff_type", "operator_name")
        .agg(
            customers.alias("active_customers"),
            money(revenue).alias("total_revenue_eur"),
            mean("revenue_amount", 4).alias("avg_revenue_per_event"),
            rounded(ratio(revenue, customers), 2).alias("revenue_per_customer"),
        )
        .orderBy(F.desc("total_revenue_eur"), "tariff_name")
    )


def calls_by_daypart(t: Tables) -> DataFrame:
    days = t["dim_time"].select("time_key", "time_of_day", "day_name", "is_weekend")
    return (
        t["fact_usage_events"]
        .join(days, "time_key")
        .groupBy("time_of_day", "day_name", "is_weekend")
        .agg(
            whole(F.sum("call_count")).alias("total_calls"),
            (whole(F.sum("total_call_duration_sec")) / 60).alias("total_minutes"),
            F.countDistinct("customer_key").alias("unique_callers"),
        )
        .orderBy(F.desc("total_calls"), "time_of_day", "day_name")
    )


def data_by_segment(t: Tables) -> DataFrame:
    customers = t["dim_customer"].where("is_current").select("customer_key", "segment")
    days = t["dim_time"].select("time_key", "month_name", "quarter")
    volume = F.sum("total_data_volume_mb")
    return (
        t["fact_usage_events"]
        .join(customers, "customer_key")
        .join(days, "time_key")
        .groupBy("month_name", "quarter", "segment")
        .agg(
            F.countDistinct("customer_key").alias("customers"),
            rounded(volume.cast("double") / 1024, 2).alias("total_data_gb"),
            mean("total_data_volume_mb", 2).alias("avg_data_mb_per_event"),
            whole(F.sum("sms_count")).alias("total_sms"),
        )
        .orderBy("quarter", "segment")
    )


def fraud_by_region(t: Tables) -> DataFrame:
    towers = t["dim_location"].select("location_key", "region", "area_type")
    risky = rows_where(F.col("fraud_score") > HIGH_RISK)
    return (
        t["fact_usage_events"]
        .join(towers, "location_key")
        .groupBy("region", "area_type")
        .agg(
            rows().alias("total_events"),
            risky.alias("high_risk_events"),
            mean("fraud_score", 3).alias("avg_fraud_score"),
            F.max("fraud_score").alias("max_fraud_score"),
            percent(risky, rows()).alias("fraud_rate_pct"),
        )
        .orderBy(F.desc("avg_fraud_score"), "region", "area_type")
    )


def orphan_summary(t: Tables) -> DataFrame:
    """Fact rows without a calendar row or a customer."""
    wanted = [r for r in REFERENCES["fact_usage_events"] if r.parent in ("dim_time", "dim_customer")]
    checks = check_references(t["fact_usage_events"], wanted, {r.parent: t[r.parent] for r in wanted})
    label = F.when(F.col("rule_id") == "RI-02", "fact -> dim_time orphans").otherwise("fact -> dim_customer orphans")
    return checks.select(label.alias("check_name"), F.col("failed_rows").alias("n"))


def staging_pass_rate(t: Tables) -> DataFrame:
    valid, rejected = (rows_where(F.col("etl_status") == status) for status in ("VALID", "REJECTED"))
    return (
        t["stg_cdr"]
        .groupBy("etl_load_date")
        .agg(
            rows().alias("total_staged"),
            valid.alias("valid_rows"),
            rejected.alias("rejected_rows"),
            percent(valid, rows()).alias("pass_pct"),
        )
        .orderBy(F.desc("etl_load_date"))
    )


def top_tariffs(t: Tables, k: int = 5) -> DataFrame:
    plans = t["dim_tariff"].select("tariff_key", "tariff_name")
    revenue = t["fact_usage_events"].join(plans, "tariff_key").groupBy("tariff_name")
    return revenue.agg(money(F.sum("revenue_amount")).alias("revenue")).orderBy(F.desc("revenue"), "tariff_name").limit(k)


def fraud_bands(t: Tables) -> DataFrame:
    score = F.col("fraud_score")
    band = F.when(score < 0.3, "Low").when(score < 0.6, "Medium").when(score < 0.8, "High").otherwise("Critical")
    return t["fact_usage_events"].groupBy(band.alias("risk_level")).agg(rows().alias("n_events")).orderBy("risk_level")


def fraud_by_scenario(t: Tables) -> DataFrame:
    return (
        t["cdr"]
        .where("fraud_scenario is not null")
        .groupBy("fraud_scenario")
        .agg(
            rows().alias("n_events"),
            F.min("fraud_score").alias("min_score"),
            F.max("fraud_score").alias("max_score"),
            mean("fraud_score", 4).alias("avg_score"),
        )
    )


def rated_usage(t: Tables) -> DataFrame:
    """Every event with a contract, priced over the plan's daily share of its allowance; a contract without a known tariff
    has no fee and no allowance."""
    plans = t["tariff"].select("tariff_id", "tariff_type", "monthly_fee", "free_minutes", "data_mb")
    terms = t["contract"].select("contract_id", "tariff_id").join(plans, "tariff_id", "left")
    usage = t["cdr"].select("src_seq", "cdr_id", "contract_id", "event_key", "duration_sec", "data_volume_mb")
    amount = rated_amount(
        *[F.col(c) for c in ("event_key", "duration_sec", "data_volume_mb", "tariff_type", "monthly_fee", "free_minutes", "data_mb")]
    )
    return usage.join(terms, "contract_id").select(
        "src_seq", "cdr_id", "contract_id", "event_key", "tariff_id", amount.alias("rated_amount")
    )


def events_in_contract(t: Tables, bin_days: int | None = None) -> DataFrame:
    spans = t["contract"].select("contract_id", "tariff_id", "start_date", "end_date")
    usage = t["cdr"].select("src_seq", "cdr_id", "contract_id", "event_datetime")
    return within_validity(usage, spans, "contract_id", "event_datetime", "start_date", "end_date", bin_days=bin_days).select(
        "src_seq", "cdr_id", "contract_id", "tariff_id", "event_datetime", "start_date", "end_date"
    )


# Declared bytes per row, layer and history type of every table.
ROW_BYTES = [
    ("Operational DB", "customer", "-", 200),
    ("Operational DB", "contract", "-", 50),
    ("Operational DB", "tariff", "-", 80),
    ("Operational DB", "operator", "-", 50),
    ("Operational DB", "device", "-", 120),
    ("Operational DB", "location", "-", 100),
    ("Operational DB", "region", "-", 50),
    ("Operational DB", "event_type", "-", 80),
    ("Operational DB", "channel", "-", 50),
    ("Operational DB", "invoice", "-", 56),
    ("Operational DB", "payment", "-", 68),
    ("Operational DB", "cdr", "-", 115),
    ("Data Warehouse", "fact_usage_events", "-", 135),
    ("Data Warehouse", "dim_customer", "SCD2", 220),
    ("Data Warehouse", "dim_time", "SCD1", 90),
    ("Data Warehouse", "dim_tariff", "SCD1", 120),
    ("Data Warehouse", "dim_event", "SCD1", 80),
    ("Data Warehouse", "dim_channel", "SCD1", 70),
    ("Data Warehouse", "dim_location", "SCD1", 115),
    ("Data Warehouse", "stg_cdr", "Staging", 150),
]
INDEX_SHARE = 0.2
INDEXED = ("cdr", "fact_usage_events")
MIB, GIB = 1048576, 1073741824


def storage_footprint(t: Tables) -> DataFrame:
    """Declared row width times actual rows, per table, largest first."""
    spark = t["cdr"].sparkSession
    values = ", ".join(f"('{layer}', '{name}', '{kind}', {width})" for layer, name, kind, width in ROW_BYTES)
    widths = spark.sql(f"select * from values {values} as w(layer, table_name, scd_type, row_size_bytes)")
    counts = reduce(
        DataFrame.unionByName,
        [t[name].agg(rows().alias("row_count")).withColumn("table_name", F.lit(name)) for _, name, _, _ in ROW_BYTES],
    )
    total = F.col("row_size_bytes") * F.col("row_count")
    return (
        widths.join(counts, "table_name")
        .select(
            "layer",
            "table_name",
            "scd_type",
            "row_size_bytes",
            "row_count",
            total.alias("total_bytes"),
            rounded(total.cast("double") / MIB, 2).alias("size_mb"),
        )
        .orderBy(F.desc("total_bytes"), "table_name")
    )


def storage_totals(t: Tables) -> DataFrame:
    """Bytes per layer, index overhead on the two event tables and the grand total."""
    sized = storage_footprint(t).select("layer", "table_name", "total_bytes")
    indexed = F.col("table_name").isin(*INDEXED)
    lines = sized.select(
        F.inline(
            F.array(
                F.struct(F.col("layer").alias("database_layer"), F.col("total_bytes").cast("double").alias("bytes")),
                F.struct(
                    F.lit("Index Overhead").alias("database_layer"),
                    F.when(indexed, F.col("total_bytes") * INDEX_SHARE).otherwise(0.0).alias("bytes"),
                ),
            )
        )
    )
    layers = lines.groupBy("database_layer").agg(F.sum("bytes").cast("bigint").alias("total_bytes"))
    total = layers.agg(F.sum("total_bytes").alias("total_bytes")).select(F.lit("TOTAL").alias("database_layer"), "total_bytes")
    return (
        layers.unionByName(total)
        .select(
            "database_layer",
            "total_bytes",
            rounded(F.col("total_bytes").cast("double") / MIB, 1).alias("size_mb"),
            rounded(F.col("total_bytes").cast("double") / GIB, 3).alias("size_gb"),
        )
        .orderBy(F.desc("total_bytes"), "database_layer")
    )
