"""Run reports and source-to-target reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.measures import mean, money, percent, rounded, rows, rows_where, whole
from tidewell.operators.reconcile import count_tables, side_by_side
from tidewell.operators.rules import check_references
from tidewell.plans.checks import REFERENCES, Tables
from tidewell.plans.marts import CRITICAL_RISK, HIGH_RISK, staging_pass_rate

OPERATIONAL = (
    "customer",
    "contract",
    "tariff",
    "operator",
    "device",
    "location",
    "region",
    "event_type",
    "channel",
    "invoice",
    "payment",
    "cdr",
)
DIMENSIONS = ("dim_time", "dim_tariff", "dim_event", "dim_channel", "dim_location")


def counted_once(df: DataFrame, layer: str, counts: dict[str, Column]) -> DataFrame:
    """(layer, table_name, row_count) of several counts over one scan of ``df``."""
    one = df.agg(*[count.alias(f"_{i}") for i, count in enumerate(counts.values())])
    lines = [
        F.struct(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.col(f"_{i}").alias("row_count"))
        for i, name in enumerate(counts)
    ]
    return one.select(F.inline(F.array(*lines)))


def operational_counts(t: Tables) -> DataFrame:
    return count_tables([("Operational DB", name, t[name]) for name in OPERATIONAL]).orderBy("table_name")


def staging_status(t: Tables) -> DataFrame:
    """Rows and share per status. The window runs over the handful of aggregated statuses."""
    counted = t["stg_cdr"].groupBy("etl_status").agg(rows().alias("row_count"))
    share = percent(F.col("row_count"), F.sum("row_count").over(Window.partitionBy()))
    return counted.select(F.lit("Staging").alias("layer"), "etl_status", "row_count", share.alias("pct")).orderBy("etl_status")


def staging_vs_source(t: Tables) -> DataFrame:
    counts = count_tables([("", "stg_cdr", t["stg_cdr"]), ("", "cdr", t["cdr"])])
    gap = F.col("stg_rows") - F.col("cdr_rows")
    return side_by_side(counts, {"stg_rows": "stg_cdr", "cdr_rows": "cdr"}).select(
        F.lit("Reconciliation").alias("check_type"),
        F.lit("STG total vs CDR total").alias("description"),
        "stg_rows",
        "cdr_rows",
        gap.alias("difference"),
        F.when(gap == 0, "MATCH").otherwise("MISMATCH").alias("result"),
    )


def warehouse_counts(t: Tables) -> DataFrame:
    current, past = rows_where(F.col("is_current")), rows_where(~F.col("is_current"))
    customers = {"dim_customer (all)": rows(), "dim_customer (current)": current, "dim_customer (historical)": past}
    others = count_tables([("DWH Dimension", name, t[name]) for name in (*DIMENSIONS, "fact_usage_events")])
    return others.unionByName(counted_once(t["dim_customer"], "DWH Dimension", customers)).orderBy("table_name")


def customer_vs_dimension(t: Tables) -> DataFrame:
    counts = count_tables(
        [("", "customer", t["customer"]), ("", "current", t["dim_customer"].where("is_current and customer_id > 0"))]
    )
    gap = F.col("source_rows") - F.col("dwh_rows")
    return side_by_side(counts, {"source_rows": "customer", "dwh_rows": "current"}).select(
        F.lit("Reconciliation").alias("check_type"),
        F.lit("customer vs dim_customer (current)").alias("description"),
        "source_rows",
        "dwh_rows",
        gap.alias("difference"),
        F.when(gap == 0, "MATCH").otherwise("CHECK").alias("result"),
    )


def valid_vs_fact(t: Tables) -> DataFrame:
    counts = count_tables(
        [("", "valid", t["stg_cdr"].where("etl_status = 'VALID'")), ("", "fact", t["fact_usage_events"])]
    )
    return side_by_side(counts, {"valid_staged": "valid", "fact_rows": "fact"}).select(
        F.lit("Reconciliation").alias("check_type"),
        F.lit("STG VALID vs fact_usage_events").alias("description"),
        "valid_staged",
        "fact_rows",
        F.when(F.col("fact_rows") > 0, "Fact table populated").otherwise("FAIL").alias("result"),
    )


def pass_history(t: Tables) -> DataFrame:
    return staging_pass_rate(t).withColumnRenamed("pass_pct", "pass_rate_pct")


def layer_counts(t: Tables) -> DataFrame:
    """Row counts of both layers and the staging outcome as (layer, table_name, row_count, pass_rate_pct)."""
    warehouse = ("dim_customer", *DIMENSIONS, "fact_usage_events")
    counts = count_tables(
        [("business_db", name, t[name]) for name in OPERATIONAL] + [("dwh", name, t[name]) for name in warehouse]
    ).withColumn("pass_rate_pct", F.lit(None).cast("double"))
    valid, rejected = (rows_where(F.col("etl_status") == status) for status in ("VALID", "REJECTED"))
    outcome = t["stg_cdr"].agg(valid.alias("_valid"), rejected.alias("_rejected"), rows().alias("_total"))
    rate = F.coalesce(percent(F.col("_valid"), F.col("_total")), F.lit(0.0))
    nothing = F.lit(None).cast("double")
    lines = [
        ("dwh", "stg_cdr", "_total", nothing),
        ("staging", "valid", "_valid", nothing),
        ("staging", "rejected", "_rejected", nothing),
        ("staging", "total", "_total", rate),
    ]
    staging = outcome.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(layer).alias("layer"),
                        F.lit(name).alias("table_name"),
                        F.col(column).alias("row_count"),
                        pct.alias("pass_rate_pct"),
                    )
                    for layer, name, column, pct in lines
                ]
            )
        )
    )
    return counts.unionByName(staging)


def run_summary(t: Tables) -> DataFrame:
    """Report 1: section / metric / value lines for the latest load."""
    staged = t["stg_cdr"]
    latest = staged.agg(F.max("etl_load_date").alias("day")).scalar()
    valid, rejected = (rows_where(F.col("etl_status") == status) for status in ("VALID", "REJECTED"))
    totals = staged.where(F.col("etl_load_date") == latest).agg(
        F.max("etl_load_date").cast("string").alias("Run Date"),
        rows().cast("string").alias("Total Staged"),
        valid.cast("string").alias("Valid Rows"),
        rejected.cast("string").alias("Rejected Rows"),
        percent(valid, rows()).cast("string").alias("Pass Rate %"),
    )
    nothing = F.lit(None).cast("string")
    title = F.struct(F.lit("=== ETL RUN SUMMARY ===").alias("section"), nothing.alias("metric"), nothing.alias("value"))
    lines = [F.struct(nothing.alias("section"), F.lit(c).alias("metric"), F.col(c).alias("value")) for c in totals.columns]
    return totals.select(F.inline(F.array(title, *lines)))


def status_distribution(t: Tables) -> DataFrame:
    """Report 2: rows per load and status with their share of the load."""
    counted = t["stg_cdr"].groupBy("etl_load_date", "etl_status").agg(rows().alias("row_count"))
    share = percent(F.col("row_count"), F.sum("row_count").over(Window.partitionBy("etl_load_date")))
    return counted.select(
        F.col("etl_load_date").alias("run_date"), "etl_status", "row_count", share.alias("pct_of_batch")
    ).orderBy(F.desc("run_date"), "etl_status")


def table_snapshot(t: Tables) -> DataFrame:
    """Report 3: rows of the main tables in layer order."""
    by_status = {f"stg_cdr ({s})": rows_where(F.col("etl_status") == s) for s in ("VALID", "REJECTED")}
    customers = {"dim_customer (all)": rows(), "dim_customer (curr)": rows_where(F.col("is_current"))}
    counts = (
        count_tables(
            [("Business DB", name, t[name]) for name in ("customer", "contract", "cdr", "invoice", "payment")]
            + [("DWH", name, t[name]) for name in (*DIMENSIONS, "fact_usage_events")]
        )
        .unionByName(counted_once(t["stg_cdr"], "Staging", by_status))
        .unionByName(counted_once(t["dim_customer"], "DWH", customers))
    )
    name = F.col("table_name")
    status = (
        F.when(name == "stg_cdr (VALID)", "OK")
        .when(name == "stg_cdr (REJECTED)", F.when(F.col("row_count") == 0, "OK").otherwise("WARN"))
        .otherwise("-")
    )
    rank = F.when(F.col("layer") == "Business DB", 1).when(F.col("layer") == "Staging", 2).otherwise(3)
    return counts.select("layer", "table_name", "row_count", status.alias("status")).orderBy(rank, "table_name")


def version_report(t: Tables) -> DataFrame:
    """Report 4a. The unknown member is not a customer."""
    history = rows_where("not is_current")
    return t["dim_customer"].agg(
        F.first(F.lit("SCD2 DIM_CUSTOMER Activity")).alias("report"),
        rows().alias("total_rows"),
        rows_where("is_current").alias("current_rows"),
        history.alias("historical_rows"),
        (F.countDistinct("customer_id") - 1).alias("unique_customers"),
        history.alias("total_scd2_versions_created"),
    )


def version_history(t: Tables, k: int = 10) -> DataFrame:
    """Report 4b: the customers with most versions."""
    versions = t["dim_customer"].where("customer_id > 0").groupBy("customer_id")
    return (
        versions.agg(
            rows().alias("version_count"),
            F.min("effective_from").alias("first_seen"),
            F.max(F.when(F.col("is_current"), F.col("effective_from"))).alias("last_updated"),
        )
        .where("version_count > 1")
        .orderBy(F.desc("version_count"), "customer_id")
        .limit(k)
    )


def fraud_summary(t: Tables) -> DataFrame:
    """Report 5."""
    risky = rows_where(F.col("fraud_score") > HIGH_RISK)
    return t["fact_usage_events"].agg(
        F.first(F.lit("Fraud Summary")).alias("report"),
        rows().alias("total_events"),
        risky.alias("high_risk_events"),
        rows_where(F.col("fraud_score") > CRITICAL_RISK).alias("critical_risk_events"),
        mean("fraud_score", 4).alias("avg_fraud_score"),
        F.max("fraud_score").alias("max_fraud_score"),
        percent(risky, rows(), 3).alias("high_risk_rate_pct"),
    )


def integrity_summary(t: Tables) -> DataFrame:
    """Report 6: orphans of eight relations, one scan per child table."""
    wanted = {
        "fact_usage_events": REFERENCES["fact_usage_events"],
        "payment": [r for r in REFERENCES["payment"] if r.rule_id == "RI-07"],
        "device": REFERENCES["device"],
    }
    parts = [check_references(t[child], refs, {r.parent: t[r.parent] for r in refs}) for child, refs in wanted.items()]
    fact, payment, device = parts
    return (
        fact.unionByName(payment)
        .unionByName(device)
        .select("check_name", F.col("failed_rows").alias("orphan_rows"), F.col("status").alias("result"))
        .orderBy(F.desc("orphan_rows"), "check_name")
    )


def usage_kpis(t: Tables) -> DataFrame:
    """Report 7: totals over facts of known customers."""
    return (
        t["fact_usage_events"]
        .where("customer_key > 0")
        .agg(
            F.first(F.lit("Revenue KPIs")).alias("report"),
            money(F.sum("revenue_amount")).alias("total_revenue_eur"),
            mean("revenue_amount", 4).alias("avg_per_event_eur"),
            whole(F.sum("call_count")).alias("total_calls"),
            whole(F.sum("sms_count")).alias("total_sms"),
            rounded(F.sum("total_data_volume_mb").cast("double") / 1024, 1).alias("total_data_gb"),
            whole(F.sum("event_count")).alias("total_events"),
            F.countDistinct("customer_key").alias("active_customers"),
        )
    )
