"""Data-quality, business-rule and referential checks of the usage warehouse, declared as data.

``tables`` maps table names of both layers to DataFrames. Row rules of one table share one scan, references
of one child table share another; only grouping and interval rules have a plan of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import intervals
from tidewell.operators.dimensions import ambiguous_entities
from tidewell.operators.rollup import GRAIN, MEASURES
from tidewell.operators.rules import Reference, Rule, check_references, check_rows, check_total, repeated_groups

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Bounds:
    """Run parameters of the checks: today's date, the expected event window, the least calendar size."""

    as_of: date
    first_day: date
    last_day: date
    calendar_rows: int = 1460


# Allowed code lists and the bounding box of the network.
CALL_TYPES = "('Outgoing', 'Incoming', 'N/A')"
SEGMENTS = "('Budget', 'Standard', 'Premium', 'Business', 'Senior')"
TARIFF_TYPES = "('Prepaid', 'Postpaid')"
OUTSIDE_BOX = "latitude < 46.37 or latitude > 49.02 or longitude < 9.53 or longitude > 17.16"


# Check names below are output values of the reports and fixed with their ids.
def row_rules(bounds: Bounds) -> dict[str, list[Rule]]:
    """Rules that count rows of one table, by table."""
    return {
        "stg_cdr": [
            Rule("DQ-01", "STG: NULL contract_id", "contract_id is null"),
            Rule("DQ-02", "STG: NULL event_key", "event_key is null"),
            Rule("DQ-03", "STG: NULL event_datetime", "event_datetime is null"),
            Rule("DQ-04", "STG: duration_sec < 0", "duration_sec < 0"),
            Rule("DQ-05", "STG: data_volume_mb < 0", "data_volume_mb < 0"),
            Rule("DQ-06", "STG: fraud_score NOT IN [0,1]", "fraud_score < 0 or fraud_score > 1"),
            Rule("DQ-07", "STG: cost < 0", "cost < 0"),
            Rule("DQ-09", "STG: event_datetime in future", f"to_date(event_datetime) > date '{bounds.as_of}'", "WARN"),
            Rule("DQ-10", "STG: Invalid call_type", f"call_type not in {CALL_TYPES}"),
        ],
        "customer": [
            Rule("DQ-11", "BIZ: Customer NULL name", "first_name is null or last_name is null"),
            Rule("DQ-12", "BIZ: Invalid customer segment", f"segment not in {SEGMENTS}"),
        ],
        "contract": [
            Rule("DQ-13", "BIZ: Contract end < start", "end_date <= start_date"),
            Rule("BR-03", "Closed contract without end_date", "status = 'Closed' and end_date is null"),
        ],
        "tariff": [
            Rule("DQ-14", "BIZ: Tariff fee < 0", "monthly_fee < 0"),
            Rule("BR-05", "Invalid tariff_type", f"tariff_type not in {TARIFF_TYPES}"),
        ],
        "invoice": [Rule("DQ-15", "BIZ: Invoice amount <= 0", "total_amount <= 0")],
        "location": [Rule("DQ-16", "BIZ: Latitude out of Austria", OUTSIDE_BOX, "WARN")],
        "device": [Rule("DQ-17", "BIZ: Device NULL customer_id", "customer_id is null")],
        "dim_customer": [
            Rule("DQ-19", "DWH: SCD2 date range invalid", "effective_from > effective_to"),
            Rule(
                "BR-14",
                "N/A placeholder (key=-1) missing",
                measure="case when count_if(customer_key = -1) > 0 then 0 else 1 end",
            ),
        ],
        "dim_time": [
            Rule(
                "DQ-20",
                "DWH: DIM_TIME row count check",
                "time_key > 0",
                "WARN",
                passes=f"failed_rows >= {bounds.calendar_rows}",
            )
        ],
        "fact_usage_events": [
            Rule("DQ-21", "DWH: FACT fraud_score NOT [0,1]", "fraud_score < 0 or fraud_score > 1"),
            Rule(
                "DQ-22",
                "DWH: FACT negative measures",
                "call_count < 0 or sms_count < 0 or total_call_duration_sec < 0 "
                "or total_data_volume_mb < 0 or revenue_amount < 0 or event_count < 0",
            ),
        ],
        "cdr": [
            Rule("BR-06", "Voice call with zero duration", "event_key in (1, 7) and duration_sec = 0", "WARN"),
            Rule("BR-07", "Data session with zero volume", "event_key = 3 and data_volume_mb = 0", "WARN"),
            Rule(
                "BR-08",
                "CDR outside simulation period",
                f"to_date(event_datetime) < date '{bounds.first_day}' or to_date(event_datetime) > date '{bounds.last_day}'",
                "WARN",
            ),
            Rule("BR-09", "High fraud_score without fraud_flag", "fraud_score > 0.60 and fraud_flag = false", "WARN"),
        ],
    }


REFERENCES: dict[str, list[Reference]] = {
    "fact_usage_events": [
        Reference("RI-01", "FACT → DIM_CUSTOMER", "customer_key", "dim_customer", "customer_key"),
        Reference("RI-02", "FACT → DIM_TIME", "time_key", "dim_time", "time_key"),
        Reference("RI-03", "FACT → DIM_TARIFF", "tariff_key", "dim_tariff", "tariff_key"),
        Reference("RI-04", "FACT → DIM_EVENT", "event_key", "dim_event", "event_key"),
        Reference("RI-05", "FACT → DIM_CHANNEL", "channel_key", "dim_channel", "channel_key"),
        Reference("RI-06", "FACT → DIM_LOCATION", "location_key", "dim_location", "location_key"),
    ],
    "payment": [
        Reference("RI-07", "PAYMENT → INVOICE", "invoice_id", "invoice", "invoice_id"),
        Reference("BR-11", "Payment without valid invoice", "invoice_id", "invoice", "invoice_id"),
    ],
    "device": [Reference("RI-08", "DEVICE → CUSTOMER", "customer_id", "customer", "customer_id")],
    "cdr": [Reference("RI-09", "CDR → CONTRACT", "contract_id", "contract", "contract_id")],
    "invoice": [
        Reference("RI-10", "INVOICE → CONTRACT", "contract_id", "contract", "contract_id"),
        Reference("BR-10", "Invoice for non-existent contract", "contract_id", "contract", "contract_id"),
    ],
    "contract": [Reference("BR-02", "Contract without valid tariff", "tariff_id", "tariff", "tariff_id")],
    "tariff": [Reference("BR-04", "Tariff without operator", "operator_id", "operator", "operator_id")],
}


# Declared foreign keys that no rule above covers. A missing value is allowed, an unknown one is not.
FOREIGN_KEYS: dict[str, list[Reference]] = {
    "customer": [Reference("FK-01", "customer.region_id -> region", "region_id", "region", "region_id")],
    "contract": [Reference("FK-02", "contract.customer_id -> customer", "customer_id", "customer", "customer_id")],
    "cdr": [
        Reference("FK-03", "cdr.event_key -> event_type", "event_key", "event_type", "event_key"),
        Reference("FK-04", "cdr.location_id -> location", "location_id", "location", "location_id"),
    ],
    "payment": [Reference("FK-05", "payment.contract_id -> contract", "contract_id", "contract", "contract_id")],
}


def parents_in_buckets(tables: Tables, references: list[Reference]) -> dict[tuple[str, str], DataFrame]:
    """Parents that ``tables`` keeps in hash buckets of the column referred to, by name and column."""
    find = getattr(tables, "in_buckets", lambda name, column: None)
    found = {(r.parent, r.parent_column): find(r.parent, r.parent_column) for r in references}
    return {place: frame for place, frame in found.items() if frame is not None}


def references_by_key(tables: Tables) -> DataFrame:
    """The references to customers, contracts and invoices, each joined on the parent's key."""
    parts = []
    for child in ("payment", "device", "cdr", "invoice"):
        references = REFERENCES[child]
        parts.append(check_references(tables[child], references, {}, in_buckets={(r.parent, r.parent_column): tables[r.parent] for r in references}))
    return reduce(DataFrame.unionByName, parts)


def fk_suite(tables: Tables) -> DataFrame:
    """One row for each foreign key of :data:`FOREIGN_KEYS`."""
    parts = [
        check_references(tables[table], references, {r.parent: tables[r.parent] for r in references}, False, parents_in_buckets(tables, references))
        for table, references in FOREIGN_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def payments_off_invoice(payment: DataFrame, invoice: DataFrame) -> DataFrame:
    """Payments that differ from their invoice by more than five percent."""
    billed = invoice.select("invoice_id", "total_amount")
    return payment.join(billed, "invoice_id").where("abs(amount - total_amount) > total_amount * 0.05")


def surplus_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key, in ``violations``; every row without a key is surplus. Only the key is shuffled."""
    rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select((F.col("n_rows") - F.col(key).isNotNull().cast("int")).alias("violations"))


# Rules with a plan of their own: (rule, function of tables that yields the violations).
SHAPED: dict[str, tuple[Rule, Callable[[Tables], DataFrame]]] = {
    "DQ-08": (
        Rule("DQ-08", "STG: Duplicate cdr_id"),
        lambda t: surplus_rows(t["stg_cdr"], "cdr_id"),
    ),
    "DQ-18": (
        Rule("DQ-18", "DWH: SCD2 duplicate current rows"),
        lambda t: ambiguous_entities(t["dim_customer"]),
    ),
    "BR-01": (
        Rule("BR-01", "Customer with > 1 active contract"),
        lambda t: repeated_groups(t["contract"].where("status = 'Active'"), ["customer_id"]),
    ),
    "BR-12": (
        Rule("BR-12", "Payment amount far from invoice amount", severity="WARN"),
        lambda t: payments_off_invoice(t["payment"], t["invoice"]),
    ),
    "BR-13": (
        Rule("BR-13", "Duplicate fact grain rows"),
        lambda t: repeated_groups(t["fact_usage_events"], GRAIN),
    ),
    "BR-15": (
        Rule("BR-15", "SCD2 version gaps detected", severity="WARN"),
        lambda t: intervals.later_version_gaps(t["dim_customer"]),
    ),
}
ADJACENT_GAPS = Rule("BR-15", "SCD2 gap to the next version", severity="WARN")

# The rules each summary lists, and the ones the suite runner executes.
DQ_SUMMARY = [f"DQ-{n:02d}" for n in (1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 13, 18, 19, 21, 22)]
BR_SUMMARY = [f"BR-{n:02d}" for n in (1, 3, 5, 9, 10, 11, 13, 14)]
RUNNER = [f"RI-{n:02d}" for n in range(1, 11)] + [f"DQ-{n:02d}" for n in (9, 14, 15)] + DQ_SUMMARY + BR_SUMMARY
ALL = [f"RI-{n:02d}" for n in range(1, 11)] + [f"DQ-{n:02d}" for n in range(1, 23)] + [f"BR-{n:02d}" for n in range(1, 16)]


def run_checks(tables: Tables, rule_ids: list[str], bounds: Bounds) -> DataFrame:
    """(rule_id, check_name, failed_rows, status) for the chosen rules, each table scanned as rarely as possible."""
    wanted = set(rule_ids)
    parts: list[DataFrame] = []
    for table, rules in row_rules(bounds).items():
        chosen = [rule for rule in rules if rule.rule_id in wanted]
        if chosen:
            parts.append(check_rows(tables[table], chosen))
    for table, references in REFERENCES.items():
        chosen = [reference for reference in references if reference.rule_id in wanted]
        if chosen:
            parents = {reference.parent: tables[reference.parent] for reference in chosen}
            parts.append(check_references(tables[table], chosen, parents, in_buckets=parents_in_buckets(tables, chosen)))
    for rule_id, (rule, violations) in SHAPED.items():
        if rule_id in wanted:
            parts.append(check_total(violations(tables), rule))
    return reduce(DataFrame.unionByName, parts)


def dq_summary(tables: Tables, bounds: Bounds) -> DataFrame:
    """The data-quality summary: PASS or FAIL only, worst first."""
    status = F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL")
    checks = run_checks(tables, DQ_SUMMARY, bounds).withColumn("status", status)
    return checks.orderBy(F.desc("failed_rows"), "rule_id")


def br_summary(tables: Tables, bounds: Bounds) -> DataFrame:
    status = F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL / WARN")
    checks = run_checks(tables, BR_SUMMARY, bounds).withColumn("status", status)
    return checks.orderBy(F.desc("failed_rows"), "rule_id")


def runner_suite(tables: Tables, bounds: Bounds) -> DataFrame:
    """The suite as the load runs it: references and data quality fail, business rules only warn."""
    bad = F.when(F.col("rule_id").startswith("BR"), "WARN").otherwise("FAIL")
    status = F.when(F.col("failed_rows") == 0, "PASS").otherwise(bad)
    return run_checks(tables, RUNNER, bounds).withColumn("status", status)


# Primary keys, required columns and value checks of the operational tables, reported instead of enforced.
CONSTRAINTS: dict[str, tuple[str, list[str], dict[str, str]]] = {
    "region": ("region_id", ["bundesland", "country"], {}),
    "operator": ("operator_id", ["operator_name", "country"], {}),
    "tariff": (
        "tariff_id",
        ["tariff_name", "tariff_type", "monthly_fee", "operator_id"],
        {"tariff_type": f"tariff_type in {TARIFF_TYPES}"},
    ),
    "customer": (
        "customer_id",
        ["first_name", "last_name", "country", "segment", "customer_status"],
        {"gender": "gender in ('M', 'F', 'D')", "segment": f"segment in {SEGMENTS}"},
    ),
    "device": ("device_id", ["customer_id"], {}),
    "contract": (
        "contract_id",
        ["customer_id", "tariff_id", "start_date", "status"],
        {"status": "status in ('Active', 'Closed', 'Suspended')"},
    ),
    "event_type": (
        "event_key",
        ["event_name", "event_category", "is_chargeable", "fraud_risk_level"],
        {"fraud_risk_level": "fraud_risk_level in ('Low', 'Medium', 'High', 'Critical')"},
    ),
    "channel": ("channel_id", ["channel_name", "channel_type"], {}),
    "location": (
        "location_id",
        ["country"],
        {"area_type": "area_type in ('Urban', 'Suburban', 'Rural')"},
    ),
    "cdr": (
        "cdr_id",
        ["contract_id", "event_key", "event_datetime", "cost", "fraud_flag", "fraud_score"],
        {
            "duration_sec": "duration_sec >= 0",
            "call_type": f"call_type in {CALL_TYPES}",
            "fraud_score": "fraud_score between 0 and 1",
        },
    ),
    "payment": ("payment_id", ["contract_id", "amount", "pay_date"], {"amount": "amount >= 0"}),
    "invoice": (
        "invoice_id",
        ["contract_id", "billing_period", "total_amount", "status"],
        {"status": "status in ('Pending', 'Paid', 'Overdue', 'Cancelled')"},
    ),
}
UNIQUE = {"location": ["cell_tower_id"]}
# Required columns that an insert may leave to their default. Views made without them have nothing to check.
REQUIRED_DEFAULTS = {"tariff": ["valid_from"], "customer": ["created_at"], "cdr": ["created_at"]}

# The same for the warehouse tables. Staging has no constraints.
WAREHOUSE_CONSTRAINTS: dict[str, tuple[str, list[str], dict[str, str]]] = {
    "dim_time": (
        "time_key",
        [
            "date_val",
            "day",
            "day_name",
            "week",
            "month",
            "month_name",
            "quarter",
            "year",
            "is_weekend",
            "holiday_flag",
            "time_of_day",
            "hour",
        ],
        {},
    ),
    "dim_customer": ("customer_key", ["customer_id", "effective_from", "is_current"], {}),
    "dim_tariff": ("tariff_key", ["tariff_id", "tariff_name", "tariff_type", "monthly_fee"], {}),
    "dim_event": ("event_key", ["event_name", "event_category", "is_chargeable", "fraud_risk_level"], {}),
    "dim_channel": ("channel_key", ["channel_name", "channel_type"], {}),
    "dim_location": ("location_key", ["location_id"], {}),
    "fact_usage_events": ("usage_event_key", [*GRAIN, *MEASURES], {}),
}


def constraint_suite(tables: Tables, constraints: dict[str, tuple[str, list[str], dict[str, str]]] | None = None) -> DataFrame:
    """(table_name, constraint_name, violations): one aggregation per table plus one per unique column.

    A key column that a table does not carry (rows of the fact before they are numbered) is left out, as are missing columns with a default.
    """
    parts = []
    for table, (key, required, checks) in (constraints or CONSTRAINTS).items():
        carried = tables[table].columns
        keys = [key] if key in carried else []
        defaulted = [c for c in REQUIRED_DEFAULTS.get(table, []) if c in carried]
        rules = [Rule(f"{table}|not null {c}", "", f"{c} is null") for c in [*keys, *required, *defaulted]]
        rules += [Rule(f"{table}|check {c}", "", f"not ({text})") for c, text in checks.items()]
        parts.append(check_rows(tables[table], rules))
        for column in [*keys, *UNIQUE.get(table, [])]:
            copies = repeated_groups(tables[table].where(F.col(column).isNotNull()), [column])
            parts.append(check_total(copies, Rule(f"{table}|unique {column}", "")))
    label = F.split("rule_id", "[|]")
    return reduce(DataFrame.unionByName, parts).select(
        label[0].alias("table_name"), label[1].alias("constraint_name"), F.col("failed_rows").alias("violations")
    )
