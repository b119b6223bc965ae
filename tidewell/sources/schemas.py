"""Column lists of both schemas. Defaults apply to columns an insert leaves out.

Keys, required columns and value lists are not enforced on write; ``plans.checks.constraint_suite`` and the
referential checks report them.
"""

import re

TABLES: dict[str, dict[str, str]] = {
    "ops": {
        "region": "region_id int, bundesland string, country string default 'Austria'",
        "operator": "operator_id int, operator_name string, country string default 'Austria'",
        "tariff": (
            "tariff_id int, tariff_name string, tariff_type string, monthly_fee decimal(8,2), free_minutes int, "
            "free_sms int, data_mb int, operator_id int, valid_from date default date '2024-01-01', valid_to date"
        ),
        "customer": (
            "customer_id int, first_name string, last_name string, gender string, birth_date date, age int, "
            "profession string, city string, country string default 'Austria', region_id int, segment string, "
            "customer_status string default 'Active', created_at date default current_date()"
        ),
        "device": (
            "device_id int, customer_id int, manufacturer string, model string, os_type string, "
            "device_type string default 'Smartphone', registered_at date"
        ),
        "contract": (
            "contract_id int, customer_id int, tariff_id int, start_date date, end_date date, status string default 'Active'"
        ),
        "event_type": (
            "event_key int, event_name string, event_category string, is_chargeable boolean default true, "
            "fraud_risk_level string default 'Low'"
        ),
        "channel": "channel_id int, channel_name string, channel_type string",
        "location": (
            "location_id int, country string default 'Austria', region string, city string, cell_tower_id string, "
            "area_type string, latitude decimal(9,6), longitude decimal(9,6)"
        ),
        "cdr": (
            "cdr_id bigint, contract_id int, receiver_id int, event_key int, event_datetime timestamp_ntz, "
            "duration_sec int default 0, data_volume_mb decimal(12,4) default 0, location_id int, "
            "cost decimal(10,4) default 0, call_type string, fraud_flag boolean default false, "
            "fraud_score decimal(5,2) default 0, fraud_scenario string, created_at timestamp default current_timestamp(), day int"
        ),
        "payment": (
            "payment_id bigint, contract_id int, invoice_id bigint, amount decimal(10,2), pay_date date, method string"
        ),
        "invoice": (
            "invoice_id bigint, contract_id int, billing_period string, total_amount decimal(10,2), "
            "status string default 'Pending'"
        ),
    },
    "dwh": {
        "stg_cdr": (
            "cdr_id bigint, contract_id int, receiver_id int, event_key int, event_datetime timestamp_ntz, "
            "duration_sec int, data_volume_mb decimal(12,4), location_id int, cost decimal(10,4), call_type string, "
            "fraud_flag boolean, fraud_score decimal(5,2), fraud_scenario string, created_at timestamp, "
            "src_seq bigint, etl_load_date date, etl_status string, day int"
        ),
        "dim_time": (
            "time_key int, date_val date, day int, day_name string, week int, week_name string, month int, "
            "month_name string, quarter int, year int, is_weekend boolean, holiday_flag boolean default false, "
            "time_of_day string, hour int default 0"
        ),
        "dim_customer": (
            "customer_key bigint, customer_id int, first_name string, last_name string, gender string, "
            "birth_date date, age int, profession string, city string, country string, segment string, "
            "customer_status string, effective_from date, effective_to date, is_current boolean default true"
        ),
        "dim_tariff": (
            "tariff_key int, tariff_id int, tariff_name string, tariff_type string, monthly_fee decimal(8,2), "
            "free_minutes int, free_sms int, data_mb int, operator_name string, operator_country string"
        ),
        "dim_event": (
            "event_key int, event_name string, event_category string, is_chargeable boolean default true, "
            "fraud_risk_level string default 'Low'"
        ),
        "dim_channel": "channel_key int, channel_name string, channel_type string",
        "dim_location": (
            "location_key int, location_id int, country string, region string, city string, cell_tower_id string, "
            "area_type string, latitude decimal(10,6), longitude decimal(10,6)"
        ),
        "fact_usage_events": (
            "usage_event_key bigint, customer_key bigint, time_key int, tariff_key int, event_key int, "
            "channel_key int, location_key int, call_count bigint default 0, sms_count bigint default 0, "
            "total_call_duration_sec bigint default 0, total_data_volume_mb decimal(18,2) default 0, "
            "revenue_amount decimal(18,2) default 0, roaming_revenue decimal(18,2) default 0, "
            "international_revenue decimal(18,2) default 0, discount_amount decimal(18,2) default 0, "
            "fraud_score decimal(5,2) default 0, event_count bigint default 1, day int"
        ),
        "etl_audit": (
            "run_id string, extracted bigint, valid bigint, rejected bigint, valid_without_location bigint, "
            "fact_rows bigint, first_day date, last_day date"
        ),
    },
}

_EVENT_DAY = "year(event_datetime) * 10000 + month(event_datetime) * 100 + day(event_datetime)"

# Tables of the size of the facts are kept in day partitions (yyyymmdd); how the day follows from the other columns.
DAYS = {"cdr": _EVENT_DAY, "stg_cdr": _EVENT_DAY, "fact_usage_events": "cast(floor(time_key / 100) as int)"}
# Tables that others refer to and that grow with the customers are kept in hash buckets of this column.
BUCKETS = {"customer": "customer_id", "contract": "contract_id", "invoice": "invoice_id", "dim_customer": "customer_id"}
# Surrogate keys, for which the table keeps the last one given out.
KEYS = {"fact_usage_events": "usage_event_key", "dim_customer": "customer_key"}


def columns_of(table: str) -> dict[str, tuple[str, str | None]]:
    """Type and default of each column of a table."""
    listed = next(tables[table] for tables in TABLES.values() if table in tables)
    out = {}
    for column in re.split(r", (?=[a-z_]+ [a-z])", listed):
        name, kind = column.split(" ", 1)
        kind, _, default = kind.partition(" default ")
        out[name] = (kind, default or None)
    return out
