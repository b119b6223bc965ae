"""All queries by name; each takes (spark, folder of parquet tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.calendar import time_key
from tidewell.functions.measures import money, rows
from tidewell.operators import dedup, dimensions, intervals, rollup, validate
from tidewell.operators.keys import next_after, number_sorted
from tidewell.operators.rules import check_references, check_rows, check_total, summarize
from tidewell.plans import checks, load_run, marts, reports
from tidewell.plans.fixture_tables import BOUNDS, HORIZON, SECOND_LOAD, STAGE_DATE, WINDOW, FixtureTables
from tidewell.session import materialize
from tidewell.sources.files import read_parquet
from tidewell.sources.tables import query

Query = Callable[[SparkSession, str], DataFrame]

FACT_COLUMNS = ["usage_event_key", *rollup.GRAIN, *rollup.MEASURES]

# Names of the event kinds by key.
EVENT_NAMES = [
    (1, "Outgoing Call"),
    (2, "SMS Sent"),
    (3, "Data Session Start"),
    (4, "Billing Charge"),
    (7, "International Call"),
    (10, "Device Registration"),
    (11, "Short Call"),
]


def _over(build: Callable[[FixtureTables], DataFrame]) -> Query:
    return lambda spark, folder: build(FixtureTables(spark, folder))


def _history(t: FixtureTables) -> FixtureTables:
    """Use the long order-based version history in place of the customer dimension."""
    return t.swap(dim_customer=t["customer_history"])


def _param_scan(t: FixtureTables) -> DataFrame:
    sql = "select src_seq, contract_id, event_key, cost from {cdr} where event_key = :key and cost >= :floor"
    return query(t.spark, sql, {"key": 4, "floor": 25}, cdr=t["cdr"])


def _inline_rows(t: FixtureTables) -> DataFrame:
    names = t.spark.createDataFrame(EVENT_NAMES, "event_key int, event_name string")
    return t["cdr"].join(names, "event_key").groupBy("event_key", "event_name").agg(rows().alias("n_events"))


def _window(t: FixtureTables) -> DataFrame:
    return load_run.in_window(t["cdr"], *WINDOW)


def _split(t: FixtureTables) -> DataFrame:
    valid, rejected = validate.split(t["stg_cdr"])
    sums = [rows().alias("n_rows"), F.sum("cost").cast("decimal(18,4)").alias("cost")]
    return valid.agg(F.lit("valid").alias("part"), *sums).unionByName(rejected.agg(F.lit("rejected").alias("part"), *sums))


def _tariff_change(t: FixtureTables) -> DataFrame:
    """A source where prepaid plans were repriced and the others are not delivered."""
    repriced = (F.col("monthly_fee") + 5).cast("decimal(8,2)")
    source = t["dim_tariff"].where("tariff_type = 'Prepaid'").withColumn("monthly_fee", repriced)
    return dimensions.overwrite_by_key(t["dim_tariff"], source, "tariff_key")


def _changes_applied(t: FixtureTables) -> DataFrame:
    """The second customer load by its changes alone, as the window load does it for the slices they touch."""
    existing = t["dim_customer_initial"]
    changes = materialize(dimensions.version_changes(existing, t["customer_day2"]), "changes")
    return dimensions.apply_changes(existing, changes, SECOND_LOAD, next_after(existing, "customer_key"))


def _fact_with_keys(t: FixtureTables) -> DataFrame:
    return number_sorted(t["fact_usage_events"], rollup_order(), "usage_event_key").select(*FACT_COLUMNS)


def rollup_order() -> list[str]:
    return ["contract_id", "time_key", "event_key", "location_key"]


def _point_in_time(t: FixtureTables) -> DataFrame:
    fact = rollup.resolve_keys_at_event(t["usage_rollup"], t["contract"], t["dim_customer"])
    return fact.select("contract_id", *rollup.GRAIN, *rollup.MEASURES)


def _suite_tables(t: FixtureTables) -> FixtureTables:
    """Tables that several checks read are written once per suite."""
    return t.keep("stg_cdr", "dim_customer", "fact_usage_events")


def _single_checks() -> dict[str, Query]:
    out: dict[str, Query] = {}
    name = lambda rule_id: rule_id.lower().replace("-", "_")
    for table, rules in checks.row_rules(BOUNDS).items():
        for rule in rules:
            # Staging checks run before validation sets the status.
            source = {"DQ-19": "customer_history"}.get(rule.rule_id, "stg_pending" if table == "stg_cdr" else table)
            out[name(rule.rule_id)] = _over(lambda t, s=source, r=rule: check_rows(t[s], [r]))
    for child, references in checks.REFERENCES.items():
        for ref in references:
            out[name(ref.rule_id)] = _over(lambda t, c=child, r=ref: check_references(t[c], [r], {r.parent: t[r.parent]}))
    for rule_id, (rule, violations) in checks.SHAPED.items():
        # DQ-18 and BR-15 read the long history; DQ-08 runs before validation sets the status.
        view = {"DQ-18": _history, "BR-15": _history, "DQ-08": lambda t: t.swap(stg_cdr=t["stg_pending"])}.get(rule_id, lambda t: t)
        out[name(rule_id)] = _over(lambda t, r=rule, v=violations, w=view: check_total(v(w(t)), r))
    out["br_15_adjacent"] = _over(
        lambda t: check_total(intervals.adjacent_version_gaps(t["customer_history"]), checks.ADJACENT_GAPS)
    )
    return out


def queries() -> dict[str, Query]:
    lineitem_order = [
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    ]
    built: dict[str, Callable[[FixtureTables], DataFrame]] = {
        # scans and extracts
        "src_scan": lambda t: read_parquet(t.spark, f"{t.folder}/events.parquet"),
        "src_param_scan": _param_scan,
        "src_drop_columns": lambda t: t["customer"].drop("first_name", "last_name", "birth_date"),
        "src_inline_rows": _inline_rows,
        "extract_window": _window,
        "extract_tariff_dim": lambda t: t["dim_tariff"],
        "extract_location_dim": lambda t: t["dim_location"],
        # staging and validation
        "stage_cdr": lambda t: t["stg_pending"],
        "validate_cdr": lambda t: t["stg_cdr"],
        "validate_split": _split,
        "validate_report": lambda t: validate.report(t["stg_pending"]),
        "validate_pass_rate": lambda t: validate.pass_rate(t["stg_cdr"]),
        "dedup_keep_first": lambda t: dedup.keep_first(
            read_parquet(t.spark, f"{t.folder}/lineitem.parquet"), ["l_orderkey", "l_linenumber"], lineitem_order
        ),
        # dimensions
        "dim_time": lambda t: t["dim_time"],
        "dim_tariff": lambda t: dimensions.overwrite_by_key(t["dim_tariff"].where("tariff_type = 'Prepaid'"), t["dim_tariff"], "tariff_key"),
        "scd1_upsert": _tariff_change,
        "dim_location": lambda t: t["dim_location"],
        "dim_event": lambda t: t["dim_event"],
        "dim_channel": lambda t: t["dim_channel"],
        "dim_customer_unknown": lambda t: dimensions.unknown_customer(t.spark).unionByName(
            t["dim_customer_initial"].where("customer_key > 0")
        ),
        "scd2_initial": lambda t: t["dim_customer_initial"],
        "scd2_apply": lambda t: t["dim_customer"],
        "scd2_apply_changes": _changes_applied,
        "scd2_activity": lambda t: dimensions.version_activity(t["dim_customer_initial"], t["customer_day2"]),
        "scd2_multi_current": lambda t: dimensions.ambiguous_entities(t["customer_history"]),
        # fact
        "fact_time_key": lambda t: t["cdr"].select("src_seq", time_key(F.col("event_datetime")).alias("time_key")),
        "fact_rollup": lambda t: t["usage_rollup"],
        "fact_usage_events": _fact_with_keys,
        "fact_declared_grain": lambda t: rollup.at_declared_grain(t["fact_usage_events"]),
        "fact_point_in_time": _point_in_time,
        "etl_audit": lambda t: rollup.load_audit(t["stg_cdr"], t["usage_rollup"], "r1"),
        "fk_verify": marts.orphan_summary,
        # marts
        "q1_revenue_by_tariff": marts.revenue_by_tariff,
        "q2_calls_by_daypart": marts.calls_by_daypart,
        "q3_data_by_segment": marts.data_by_segment,
        "q4_fraud_by_region": marts.fraud_by_region,
        "staging_pass_rate": marts.staging_pass_rate,
        "sample_top_tariffs": marts.top_tariffs,
        "sample_fraud_bands": marts.fraud_bands,
        "rate_usage": marts.rated_usage,
        "active_contract_join": marts.events_in_contract,
        "active_contract_join_binned": lambda t: marts.events_in_contract(t, bin_days=32),
        "billing_spine": lambda t: intervals.billing_months(t["contract"], str(HORIZON)),
        "scd2_gap_days": lambda t: intervals.version_gaps(t["customer_history"]),
        "contract_overlap": lambda t: intervals.overlaps(t["contract"]),
        "fraud_by_scenario": marts.fraud_by_scenario,
        "storage_footprint": lambda t: marts.storage_footprint(_suite_tables(t)),
        "storage_totals": lambda t: marts.storage_totals(_suite_tables(t)),
        # suites
        "constraint_suite": checks.constraint_suite,
        "constraint_suite_dwh": lambda t: checks.constraint_suite(t.keep("dim_customer"), checks.WAREHOUSE_CONSTRAINTS),
        "fk_suite": checks.fk_suite,
        "ri_by_key": checks.references_by_key,
        "dq_summary": lambda t: checks.dq_summary(_suite_tables(t), BOUNDS),
        "br_summary": lambda t: checks.br_summary(t.keep("dim_customer", "fact_usage_events"), BOUNDS),
        "check_suite": lambda t: checks.run_checks(_suite_tables(t), checks.ALL, BOUNDS),
        "check_suite_runner": lambda t: checks.runner_suite(_suite_tables(t), BOUNDS),
        "check_suite_summary": lambda t: summarize(checks.run_checks(_suite_tables(t), checks.ALL, BOUNDS)),
        # reconciliation
        "recon_ops_counts": reports.operational_counts,
        "recon_staging_status": reports.staging_status,
        "recon_stg_vs_cdr": reports.staging_vs_source,
        "recon_dwh_counts": lambda t: reports.warehouse_counts(t.keep("dim_customer")),
        "recon_customer": reports.customer_vs_dimension,
        "recon_valid_vs_fact": lambda t: reports.valid_vs_fact(t.keep("stg_cdr")),
        "recon_pass_history": reports.pass_history,
        "recon_layer_counts": lambda t: reports.layer_counts(_suite_tables(t)),
        # run reports
        "report_1_run_summary": reports.run_summary,
        "report_2_status_distribution": reports.status_distribution,
        "report_3_snapshot": lambda t: reports.table_snapshot(_suite_tables(t)),
        "report_4_scd2_activity": reports.version_report,
        "report_4_scd2_history": lambda t: reports.version_history(_history(t)),
        "report_5_fraud": reports.fraud_summary,
        "report_6_integrity": lambda t: reports.integrity_summary(t.keep("dim_customer", "fact_usage_events")),
        "report_7_kpi": reports.usage_kpis,
    }
    return {name: _over(build) for name, build in built.items()} | _single_checks()
