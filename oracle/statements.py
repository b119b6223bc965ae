"""One SQL statement per query, for an engine that sees only the raw test tables.

Each statement is built from common table expressions: the input views come from the view declarations, the
warehouse tables are written out here with plain window functions, joins and scalar subqueries.
"""

from __future__ import annotations

import re

from tidewell.sources.telecom import VIEWS

FACT_COLUMNS = (
    "customer_key, time_key, tariff_key, event_key, channel_key, location_key, call_count, sms_count, "
    "total_call_duration_sec, total_data_volume_mb, revenue_amount, roaming_revenue, international_revenue, "
    "discount_amount, fraud_score, event_count"
)
GRAIN = "customer_key, time_key, tariff_key, event_key, channel_key, location_key"
VERSION = (
    "customer_key, customer_id, first_name, last_name, gender, birth_date, age, profession, city, country, segment, "
    "customer_status, effective_from, effective_to, is_current"
)
ATTRIBUTES = "first_name, last_name, gender, birth_date, age, profession, city, country, segment, customer_status"
UNKNOWN = (
    "select cast(-1 as bigint) as customer_key, -1 as customer_id, 'Unknown' as first_name, 'Unknown' as last_name, "
    "'D' as gender, cast(null as date) as birth_date, cast(null as int) as age, 'Unknown' as profession, "
    "'Unknown' as city, 'Unknown' as country, 'Unknown' as segment, 'Unknown' as customer_status, "
    "date '2000-01-01' as effective_from, cast(null as date) as effective_to, true as is_current"
)
TIME_KEY = (
    "cast((year(event_datetime) * 10000 + month(event_datetime) * 100 + day(event_datetime)) * 100 "
    "+ (hour(event_datetime) // 6) * 6 as int)"
)

# Tests a row must pass, NULL counting as failed.
TESTS = {
    "not_null_contract_id": "contract_id is not null",
    "not_null_event_key": "event_key is not null",
    "not_null_event_datetime": "event_datetime is not null",
    "duration_non_negative": "coalesce(duration_sec, 0) >= 0",
    "data_volume_non_negative": "coalesce(data_volume_mb, 0) >= 0",
    "fraud_score_in_range": "coalesce(fraud_score between 0 and 1, false)",
    "cost_non_negative": "coalesce(cost, 0) >= 0",
    "no_duplicate_cdr_id": "occurrence = 1",
}


def _fact(source: str, customers: str) -> str:
    return f"""select coalesce(d.customer_key, -1) as customer_key, r.time_key,
        coalesce(c.tariff_id, 2001) as tariff_key, r.event_key, 1 as channel_key, r.location_id as location_key,
        r.call_count, r.sms_count, r.total_call_duration_sec, r.total_data_volume_mb, r.revenue_amount,
        cast(0 as decimal(18,2)) as roaming_revenue, cast(0 as decimal(18,2)) as international_revenue,
        cast(0 as decimal(18,2)) as discount_amount, r.fraud_score, r.event_count, r.contract_id
        from {source} r left join v_contract c on c.contract_id = r.contract_id
        left join {customers}"""


TABLES: dict[str, str] = {name: view.sql() for name, view in VIEWS.items()} | {
    "w_pending": "select *, date '2024-01-31' as etl_load_date, 'PENDING' as etl_status from v_cdr",
    "w_numbered": "select *, row_number() over (partition by cdr_id order by src_seq) as occurrence from v_cdr",
    "w_stg": f"""select * exclude (occurrence), date '2024-01-31' as etl_load_date,
        case when {' and '.join(TESTS.values())} then 'VALID' else 'REJECTED' end as etl_status from w_numbered""",
    "w_rollup": f"""select contract_id, {TIME_KEY} as time_key, event_key, location_id,
        count(case when event_key in (1, 7) then 1 end) as call_count,
        count(case when event_key = 2 then 1 end) as sms_count,
        cast(coalesce(sum(duration_sec), 0) as bigint) as total_call_duration_sec,
        cast(coalesce(sum(data_volume_mb), 0) as decimal(18,2)) as total_data_volume_mb,
        cast(coalesce(sum(cost), 0) as decimal(18,2)) as revenue_amount,
        max(fraud_score) as fraud_score, count(cdr_id) as event_count
        from w_stg where etl_status = 'VALID' and location_id is not null group by all""",
    "w_initial": f"""{UNKNOWN} union all
        select row_number() over (order by customer_id), customer_id, {ATTRIBUTES}, date '2024-01-01', null, true
        from v_customer_day1""",
    "w_diff": """select o.customer_key as old_key, n.*,
        o.customer_key is null as is_new,
        o.customer_key is not null and (o.profession is distinct from n.profession or o.segment is distinct from n.segment) as is_changed
        from v_customer_day2 n left join w_initial o on o.customer_id = n.customer_id and o.is_current""",
    "w_customer": f"""select i.* replace (
            case when d.is_changed then date '2024-01-15' else i.effective_to end as effective_to,
            not coalesce(d.is_changed, false) as is_current)
        from w_initial i left join w_diff d on d.old_key = i.customer_key
        union all
        select (select max(customer_key) from w_initial) + row_number() over (order by customer_id), customer_id,
            {ATTRIBUTES}, date '2024-01-16', null, true from w_diff where is_new or is_changed""",
    "w_fact": _fact("w_rollup", "w_customer d on d.customer_id = c.customer_id and d.is_current"),
    "w_fact_then": _fact(
        "w_rollup",
        "w_customer d on d.customer_id = c.customer_id and strptime(cast(r.time_key // 100 as varchar), '%Y%m%d') "
        "between d.effective_from and coalesce(d.effective_to, date '9999-12-31')",
    ),
    "w_days": """select cast(unnest(generate_series(date_trunc('year', min(event_datetime)),
        date_trunc('year', max(event_datetime)) + interval 1 year - interval 1 day, interval 1 day)) as date) as date_val from v_cdr""",
    "w_time": """select cast((year(date_val) * 10000 + month(date_val) * 100 + day(date_val)) * 100 + h.hour as int) as time_key,
        date_val, cast(day(date_val) as int) as day, dayname(date_val) as day_name, cast(week(date_val) as int) as week,
        'W' || lpad(cast(week(date_val) as varchar), 2, '0') as week_name, cast(month(date_val) as int) as month,
        monthname(date_val) as month_name, cast(quarter(date_val) as int) as quarter, cast(year(date_val) as int) as year,
        isodow(date_val) >= 6 as is_weekend,
        strftime(date_val, '%Y-%m-%d') in ('2024-01-01', '2024-01-06', '2024-04-01', '2024-05-01', '2024-05-09', '2024-05-20',
            '2024-08-15', '2024-10-26', '2024-11-01', '2024-12-08', '2024-12-25', '2024-12-26') as holiday_flag,
        h.time_of_day, h.hour
        from w_days cross join (values (0, 'Night'), (6, 'Morning'), (12, 'Afternoon'), (18, 'Evening')) h(hour, time_of_day)""",
    "w_tariff": """select tariff_id as tariff_key, tariff_id, tariff_name, tariff_type, monthly_fee, free_minutes, free_sms,
        data_mb, o.operator_name, o.country as operator_country
        from v_tariff t join v_operator o on o.operator_id = t.operator_id""",
    "w_location": """select location_id as location_key, location_id, country, region, city, cell_tower_id, area_type,
        cast(latitude as decimal(10,6)) as latitude, cast(longitude as decimal(10,6)) as longitude from v_location""",
    "w_event": "select * from v_event_type",
    "w_channel": "select channel_id as channel_key, channel_name, channel_type from v_channel",
}


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in re.findall(r"\b[vw]_[a-z0-9_]+\b", sql):
        if name in TABLES and name not in found:
            _needed(TABLES[name], found)
            found[name] = None


def _statement(body: str) -> str:
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body
    return "with " + ",\n".join(f"{name} as ({TABLES[name]})" for name in found) + "\n" + body


def _mean(column: str, digits: int) -> str:
    return f"round(cast(sum({column}) as double) / count({column}), {digits})"


def _percent(part: str, whole: str, digits: int = 2) -> str:
    return f"round(cast({part} as double) * 100 / nullif({whole}, 0), {digits})"


VALID = "sum(case when etl_status = 'VALID' then 1 else 0 end)"
REJECTED = "sum(case when etl_status = 'REJECTED' then 1 else 0 end)"
RISKY = "sum(case when fraud_score > 0.6 then 1 else 0 end)"

MAIN: dict[str, str] = {
    "src_scan": "select * from events",
    "src_param_scan": "select src_seq, contract_id, event_key, cost from v_cdr where event_key = 4 and cost >= 25",
    "src_drop_columns": "select * exclude (first_name, last_name, birth_date) from v_customer",
    "src_inline_rows": """select event_key, event_name, count(*) as n_events from v_cdr join (values (1, 'Outgoing Call'),
        (2, 'SMS Sent'), (3, 'Data Session Start'), (4, 'Billing Charge'), (7, 'International Call'),
        (10, 'Device Registration'), (11, 'Short Call')) n(event_key, event_name) using (event_key) group by all""",
    "extract_window": "select * from v_cdr where cast(event_datetime as date) between date '2024-01-08' and date '2024-01-21'",
    "extract_tariff_dim": "select * from w_tariff",
    "extract_location_dim": "select * from w_location",
    "stage_cdr": "select * from w_pending",
    "validate_cdr": "select * from w_stg",
    "validate_split": """select case when etl_status = 'VALID' then 'valid' else 'rejected' end as part, count(*) as n_rows,
        cast(sum(cost) as decimal(18,4)) as cost from w_stg group by 1""",
    "validate_report": " union all ".join(
        f"select '{name}' as rule, count(*) filter ({test}) as passed, count(*) filter (not ({test})) as failed from w_numbered"
        for name, test in TESTS.items()
    ),
    "validate_pass_rate": f"""select count(*) as total_rows, cast({VALID} as bigint) as valid_rows,
        cast({REJECTED} as bigint) as rejected_rows, coalesce({_percent(VALID, 'count(*)', 1)}, 0) as pass_pct from w_stg""",
    "dedup_keep_first": """select * exclude (occurrence) from (select *, row_number() over (partition by l_orderkey, l_linenumber
        order by l_shipdate nulls first, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
        l_linestatus) as occurrence from lineitem) where occurrence = 1""",
    "dim_time": "select * from w_time",
    "dim_tariff": "select * from w_tariff",
    "scd1_upsert": """select * replace (cast(case when tariff_type = 'Prepaid' then monthly_fee + 5 else monthly_fee end
        as decimal(8,2)) as monthly_fee) from w_tariff""",
    "dim_location": "select * from w_location",
    "dim_event": "select * from w_event",
    "dim_channel": "select * from w_channel",
    "dim_customer_unknown": "select * from w_initial",
    "scd2_initial": "select * from w_initial",
    "scd2_apply": f"select {VERSION} from w_customer",
    "scd2_activity": """select count(*) filter (is_changed) as closed, count(*) filter (is_changed or is_new) as inserted
        from w_diff""",
    "scd2_multi_current": """select customer_id, count(*) as n_current from v_customer_history where is_current
        group by customer_id having count(*) > 1""",
    "fact_time_key": f"select src_seq, {TIME_KEY} as time_key from v_cdr",
    "fact_rollup": "select * from w_rollup",
    "fact_usage_events": f"""select row_number() over (order by contract_id, time_key, event_key, location_key) as usage_event_key,
        {FACT_COLUMNS} from w_fact""",
    "fact_declared_grain": f"""select {GRAIN}, cast(sum(call_count) as bigint) as call_count,
        cast(sum(sms_count) as bigint) as sms_count, cast(sum(total_call_duration_sec) as bigint) as total_call_duration_sec,
        cast(sum(total_data_volume_mb) as decimal(18,2)) as total_data_volume_mb,
        cast(sum(revenue_amount) as decimal(18,2)) as revenue_amount,
        cast(sum(roaming_revenue) as decimal(18,2)) as roaming_revenue,
        cast(sum(international_revenue) as decimal(18,2)) as international_revenue,
        cast(sum(discount_amount) as decimal(18,2)) as discount_amount, max(fraud_score) as fraud_score,
        cast(sum(event_count) as bigint) as event_count from w_fact group by {GRAIN}""",
    "fact_point_in_time": f"select contract_id, {FACT_COLUMNS} from w_fact_then",
    "etl_audit": f"""select 'r1' as run_id, count(*) as extracted, cast({VALID} as bigint) as valid,
        cast({REJECTED} as bigint) as rejected,
        count(*) filter (etl_status = 'VALID' and location_id is null) as valid_without_location,
        (select count(*) from w_rollup) as fact_rows from w_stg""",
    "fk_verify": """with found as (select count(*) as facts,
            count(*) filter (time_key in (select time_key from w_time where time_key is not null)) as timed,
            count(*) filter (customer_key in (select customer_key from w_customer where customer_key is not null)) as named from w_fact)
        select unnest(['fact -> dim_time orphans', 'fact -> dim_customer orphans']) as check_name,
            unnest([facts - timed, facts - named]) as n from found""",
    "q1_revenue_by_tariff": f"""select tariff_name, tariff_type, operator_name, count(distinct customer_key) as active_customers,
        cast(sum(revenue_amount) as decimal(18,2)) as total_revenue_eur, {_mean('revenue_amount', 4)} as avg_revenue_per_event,
        round(cast(sum(revenue_amount) as double) / nullif(count(distinct customer_key), 0), 2) as revenue_per_customer
        from w_fact join w_tariff using (tariff_key) group by tariff_name, tariff_type, operator_name""",
    "q2_calls_by_daypart": """select time_of_day, day_name, is_weekend, cast(sum(call_count) as bigint) as total_calls,
        cast(sum(total_call_duration_sec) as bigint) / 60 as total_minutes, count(distinct customer_key) as unique_callers
        from w_fact join w_time using (time_key) group by time_of_day, day_name, is_weekend""",
    "q3_data_by_segment": f"""select month_name, quarter, segment, count(distinct f.customer_key) as customers,
        round(cast(sum(total_data_volume_mb) as double) / 1024, 2) as total_data_gb,
        {_mean('total_data_volume_mb', 2)} as avg_data_mb_per_event, cast(sum(sms_count) as bigint) as total_sms
        from w_fact f join w_customer c on c.customer_key = f.customer_key and c.is_current
        join w_time d on d.time_key = f.time_key group by month_name, quarter, segment""",
    "q4_fraud_by_region": f"""select region, area_type, count(*) as total_events, cast({RISKY} as bigint) as high_risk_events,
        {_mean('fraud_score', 3)} as avg_fraud_score, max(fraud_score) as max_fraud_score,
        {_percent(RISKY, 'count(*)')} as fraud_rate_pct
        from w_fact join w_location using (location_key) group by region, area_type""",
    "staging_pass_rate": f"""select etl_load_date, count(*) as total_staged, cast({VALID} as bigint) as valid_rows,
        cast({REJECTED} as bigint) as rejected_rows, {_percent(VALID, 'count(*)')} as pass_pct from w_stg group by etl_load_date""",
    "recon_pass_history": f"""select etl_load_date, count(*) as total_staged, cast({VALID} as bigint) as valid_rows,
        cast({REJECTED} as bigint) as rejected_rows, {_percent(VALID, 'count(*)')} as pass_rate_pct
        from w_stg group by etl_load_date""",
    "sample_top_tariffs": """select tariff_name, cast(sum(revenue_amount) as decimal(18,2)) as revenue
        from w_fact join w_tariff using (tariff_key) group by tariff_name order by revenue desc, tariff_name limit 5""",
    "sample_fraud_bands": """select case when fraud_score < 0.3 then 'Low' when fraud_score < 0.6 then 'Medium'
        when fraud_score < 0.8 then 'High' else 'Critical' end as risk_level, count(*) as n_events from w_fact group by 1""",
    "rate_usage": """select src_seq, cdr_id, e.contract_id, event_key, c.tariff_id, cast(round(case
        when event_key in (1, 7) then greatest(0.0::double, cast(duration_sec as double) / 60 - cast(coalesce(free_minutes, 0) as double) / 30)
            * case when tariff_type = 'Prepaid' then 0.10::double else 0.05::double end
        when event_key = 3 then greatest(0.0::double, cast(data_volume_mb as double) - cast(coalesce(t.data_mb, 0) as double) / 30)
            * case when tariff_type = 'Prepaid' then 0.005::double else 0.002::double end
        when event_key = 4 then cast(coalesce(monthly_fee, 0) as double) / 30 else 0 end, 4) as decimal(12,4)) as rated_amount
        from v_cdr e join v_contract c on c.contract_id = e.contract_id left join v_tariff t on t.tariff_id = c.tariff_id""",
    "active_contract_join": """select src_seq, cdr_id, e.contract_id, tariff_id, event_datetime, start_date, end_date
        from v_cdr e join v_contract c on c.contract_id = e.contract_id
        and cast(event_datetime as date) between start_date and coalesce(end_date, date '9999-12-31')""",
    "billing_spine": """select contract_id, customer_id, tariff_id, cast(unnest(generate_series(date_trunc('month', start_date),
        coalesce(end_date, date '2024-12-31'), interval 1 month)) as date) as due_month from v_contract""",
    "contract_overlap": """select * from (select customer_id, contract_id, start_date, end_date,
        lead(start_date) over (partition by customer_id order by start_date, contract_id) as next_start from v_contract)
        where next_start <= coalesce(end_date, date '9999-12-31')""",
    "fraud_by_scenario": f"""select fraud_scenario, count(*) as n_events, min(fraud_score) as min_score,
        max(fraud_score) as max_score, {_mean('fraud_score', 4)} as avg_score
        from v_cdr where fraud_scenario is not null group by fraud_scenario""",
    "report_2_status_distribution": """select etl_load_date as run_date, etl_status, count(*) as row_count,
        round(cast(count(*) as double) * 100 / sum(count(*)) over (partition by etl_load_date), 2) as pct_of_batch
        from w_stg group by etl_load_date, etl_status""",
    "recon_staging_status": """select 'Staging' as layer, etl_status, count(*) as row_count,
        round(cast(count(*) as double) * 100 / sum(count(*)) over (), 2) as pct from w_stg group by etl_status""",
    "recon_stg_vs_cdr": """select 'Reconciliation' as check_type, 'STG total vs CDR total' as description,
        (select count(*) from w_stg) as stg_rows, (select count(*) from v_cdr) as cdr_rows,
        (select count(*) from w_stg) - (select count(*) from v_cdr) as difference,
        case when (select count(*) from w_stg) = (select count(*) from v_cdr) then 'MATCH' else 'MISMATCH' end as result""",
    "recon_customer": """select 'Reconciliation' as check_type, 'customer vs dim_customer (current)' as description,
        s as source_rows, d as dwh_rows, s - d as difference, case when s = d then 'MATCH' else 'CHECK' end as result
        from (select (select count(*) from v_customer) as s,
            (select count(*) from w_customer where is_current and customer_id > 0) as d)""",
    "recon_valid_vs_fact": """select 'Reconciliation' as check_type, 'STG VALID vs fact_usage_events' as description,
        (select count(*) from w_stg where etl_status = 'VALID') as valid_staged, (select count(*) from w_fact) as fact_rows,
        case when (select count(*) from w_fact) > 0 then 'Fact table populated' else 'FAIL' end as result""",
    "report_1_run_summary": f"""select '=== ETL RUN SUMMARY ===' as section, cast(null as varchar) as metric, cast(null as varchar) as value
        union all select null, 'Run Date', cast(max(etl_load_date) as varchar) from w_stg
        union all select null, 'Total Staged', cast(count(*) as varchar) from w_stg
        where etl_load_date = (select max(etl_load_date) from w_stg)
        union all select null, 'Valid Rows', cast(cast({VALID} as bigint) as varchar) from w_stg
        where etl_load_date = (select max(etl_load_date) from w_stg)
        union all select null, 'Rejected Rows', cast(cast({REJECTED} as bigint) as varchar) from w_stg
        where etl_load_date = (select max(etl_load_date) from w_stg)
        union all select null, 'Pass Rate %', cast({_percent(VALID, 'count(*)')} as varchar) from w_stg
        where etl_load_date = (select max(etl_load_date) from w_stg)""",
    "report_4_scd2_activity": """select 'SCD2 DIM_CUSTOMER Activity' as report, count(*) as total_rows,
        count(*) filter (is_current) as current_rows, count(*) filter (not is_current) as historical_rows,
        count(distinct customer_id) - 1 as unique_customers, count(*) filter (not is_current) as total_scd2_versions_created
        from w_customer""",
    "report_4_scd2_history": """select customer_id, count(*) as version_count, min(effective_from) as first_seen,
        max(case when is_current then effective_from end) as last_updated from v_customer_history where customer_id > 0
        group by customer_id having count(*) > 1 order by version_count desc, customer_id limit 10""",
    "report_5_fraud": f"""select 'Fraud Summary' as report, count(*) as total_events, cast({RISKY} as bigint) as high_risk_events,
        count(*) filter (fraud_score > 0.80) as critical_risk_events, {_mean('fraud_score', 4)} as avg_fraud_score,
        max(fraud_score) as max_fraud_score, {_percent(RISKY, 'count(*)', 3)} as high_risk_rate_pct from w_fact""",
    "report_7_kpi": f"""select 'Revenue KPIs' as report, cast(sum(revenue_amount) as decimal(18,2)) as total_revenue_eur,
        {_mean('revenue_amount', 4)} as avg_per_event_eur, cast(sum(call_count) as bigint) as total_calls,
        cast(sum(sms_count) as bigint) as total_sms, round(cast(sum(total_data_volume_mb) as double) / 1024, 1) as total_data_gb,
        cast(sum(event_count) as bigint) as total_events, count(distinct customer_key) as active_customers
        from w_fact where customer_key > 0""",
}

# table -> [(rule, name, condition, severity)]
ROW_CHECKS: dict[str, list[tuple[str, str, str, str]]] = {
    "w_stg": [
        ("DQ-01", "STG: NULL contract_id", "contract_id is null", "FAIL"),
        ("DQ-02", "STG: NULL event_key", "event_key is null", "FAIL"),
        ("DQ-03", "STG: NULL event_datetime", "event_datetime is null", "FAIL"),
        ("DQ-04", "STG: duration_sec < 0", "duration_sec < 0", "FAIL"),
        ("DQ-05", "STG: data_volume_mb < 0", "data_volume_mb < 0", "FAIL"),
        ("DQ-06", "STG: fraud_score NOT IN [0,1]", "fraud_score < 0 or fraud_score > 1", "FAIL"),
        ("DQ-07", "STG: cost < 0", "cost < 0", "FAIL"),
        ("DQ-09", "STG: event_datetime in future", "cast(event_datetime as date) > date '2024-01-28'", "WARN"),
        (
            "DQ-10",
            "STG: Invalid call_type",
            "call_type is not null and call_type not in ('Outgoing', 'Incoming', 'N/A')",
            "FAIL",
        ),
    ],
    "v_customer": [
        ("DQ-11", "BIZ: Customer NULL name", "first_name is null or last_name is null", "FAIL"),
        (
            "DQ-12",
            "BIZ: Invalid customer segment",
            "segment not in ('Budget', 'Standard', 'Premium', 'Business', 'Senior')",
            "FAIL",
        ),
    ],
    "v_contract": [
        ("DQ-13", "BIZ: Contract end < start", "end_date is not null and end_date <= start_date", "FAIL"),
        ("BR-03", "Closed contract without end_date", "status = 'Closed' and end_date is null", "FAIL"),
    ],
    "v_tariff": [
        ("DQ-14", "BIZ: Tariff fee < 0", "monthly_fee < 0", "FAIL"),
        ("BR-05", "Invalid tariff_type", "tariff_type not in ('Prepaid', 'Postpaid')", "FAIL"),
    ],
    "v_invoice": [("DQ-15", "BIZ: Invoice amount <= 0", "total_amount <= 0", "FAIL")],
    "v_location": [
        (
            "DQ-16",
            "BIZ: Latitude out of Austria",
            "latitude < 46.37 or latitude > 49.02 or longitude < 9.53 or longitude > 17.16",
            "WARN",
        )
    ],
    "v_device": [("DQ-17", "BIZ: Device NULL customer_id", "customer_id is null", "FAIL")],
    "w_customer": [
        (
            "DQ-19",
            "DWH: SCD2 date range invalid",
            "effective_to is not null and effective_from > effective_to",
            "FAIL",
        )
    ],
    "w_fact": [
        ("DQ-21", "DWH: FACT fraud_score NOT [0,1]", "fraud_score < 0 or fraud_score > 1", "FAIL"),
        (
            "DQ-22",
            "DWH: FACT negative measures",
            "call_count < 0 or sms_count < 0 or total_call_duration_sec < 0 or total_data_volume_mb < 0 "
            "or revenue_amount < 0 or event_count < 0",
            "FAIL",
        ),
    ],
    "v_cdr": [
        ("BR-06", "Voice call with zero duration", "event_key in (1, 7) and duration_sec = 0", "WARN"),
        ("BR-07", "Data session with zero volume", "event_key = 3 and data_volume_mb = 0", "WARN"),
        (
            "BR-08",
            "CDR outside simulation period",
            "cast(event_datetime as date) < date '2024-01-01' or cast(event_datetime as date) > date '2024-01-28'",
            "WARN",
        ),
        ("BR-09", "High fraud_score without fraud_flag", "fraud_score > 0.60 and fraud_flag = false", "WARN"),
    ],
}

# (rule, name, child, column, parent, parent column)
FOREIGN_KEYS = [
    ("FK-01", "customer", "region_id", "region", "region_id"),
    ("FK-02", "contract", "customer_id", "customer", "customer_id"),
    ("FK-03", "cdr", "event_key", "event_type", "event_key"),
    ("FK-04", "cdr", "location_id", "location", "location_id"),
    ("FK-05", "payment", "contract_id", "contract", "contract_id"),
]

REFERENCES = [
    ("RI-01", "FACT → DIM_CUSTOMER", "w_fact", "customer_key", "w_customer", "customer_key"),
    ("RI-02", "FACT → DIM_TIME", "w_fact", "time_key", "w_time", "time_key"),
    ("RI-03", "FACT → DIM_TARIFF", "w_fact", "tariff_key", "w_tariff", "tariff_key"),
    ("RI-04", "FACT → DIM_EVENT", "w_fact", "event_key", "w_event", "event_key"),
    ("RI-05", "FACT → DIM_CHANNEL", "w_fact", "channel_key", "w_channel", "channel_key"),
    ("RI-06", "FACT → DIM_LOCATION", "w_fact", "location_key", "w_location", "location_key"),
    ("RI-07", "PAYMENT → INVOICE", "v_payment", "invoice_id", "v_invoice", "invoice_id"),
    ("RI-08", "DEVICE → CUSTOMER", "v_device", "customer_id", "v_customer", "customer_id"),
    ("RI-09", "CDR → CONTRACT", "v_cdr", "contract_id", "v_contract", "contract_id"),
    ("RI-10", "INVOICE → CONTRACT", "v_invoice", "contract_id", "v_contract", "contract_id"),
    ("BR-02", "Contract without valid tariff", "v_contract", "tariff_id", "v_tariff", "tariff_id"),
    ("BR-04", "Tariff without operator", "v_tariff", "operator_id", "v_operator", "operator_id"),
    ("BR-10", "Invoice for non-existent contract", "v_invoice", "contract_id", "v_contract", "contract_id"),
    ("BR-11", "Payment without valid invoice", "v_payment", "invoice_id", "v_invoice", "invoice_id"),
]


def _count(name: str, label: str, number: str, source: str, bad: str, good: str = "n = 0") -> str:
    return (
        f"select '{name}' as rule_id, '{label}' as check_name, cast(n as bigint) as failed_rows, "
        f"case when {good} then 'PASS' else '{bad}' end as status from (select {number} as n from {source})"
    )


def checks(dimension: str = "w_customer") -> dict[str, str]:
    """Check statements by rule id; version checks read ``dimension``."""
    out = {}
    for table, rules in ROW_CHECKS.items():
        source = dimension if table == "w_customer" else table
        for rule, label, condition, bad in rules:
            out[rule] = _count(rule, label, "count(*)", f"{source} where {condition}", bad)
    out["DQ-08"] = _count("DQ-08", "STG: Duplicate cdr_id", "count(*) - count(distinct cdr_id)", "w_stg", "FAIL")
    out["DQ-18"] = _count(
        "DQ-18",
        "DWH: SCD2 duplicate current rows",
        "count(*)",
        f"(select customer_id from {dimension} where is_current group by customer_id having count(*) > 1)",
        "FAIL",
    )
    out["DQ-20"] = _count(
        "DQ-20", "DWH: DIM_TIME row count check", "count(*)", "w_time where time_key > 0", "WARN", "n >= 1460"
    )
    for rule, label, child, column, parent, key in REFERENCES:
        missing = f"{child} c where not exists (select 1 from {parent} p where p.{key} = c.{column})"
        out[rule] = _count(rule, label, "count(*)", missing, "FAIL")
    out["BR-01"] = _count(
        "BR-01",
        "Customer with > 1 active contract",
        "count(*)",
        "(select customer_id from v_contract where status = 'Active' group by customer_id having count(*) > 1)",
        "FAIL",
    )
    out["BR-12"] = _count(
        "BR-12",
        "Payment amount far from invoice amount",
        "count(*)",
        "v_payment p join v_invoice i on i.invoice_id = p.invoice_id where abs(p.amount - i.total_amount) > i.total_amount * 0.05",
        "WARN",
    )
    out["BR-13"] = _count(
        "BR-13",
        "Duplicate fact grain rows",
        "count(*)",
        f"(select {GRAIN} from w_fact group by {GRAIN} having count(*) > 1)",
        "FAIL",
    )
    out["BR-14"] = _count(
        "BR-14",
        "N/A placeholder (key=-1) missing",
        "case when exists (select 1 from w_customer where customer_key = -1) then 0 else 1 end",
        "(select 1)",
        "FAIL",
    )
    out["BR-15"] = _count(
        "BR-15",
        "SCD2 version gaps detected",
        "count(*)",
        "(select unnest(starts) as other_start, greatest(effective_from, effective_to + 1) as latest from (select effective_from, "
        f"effective_to, is_current, list(effective_from) over (partition by customer_id) as starts from {dimension}) "
        "where not is_current and effective_to is not null) where other_start > latest",
        "WARN",
    )
    return out


ADJACENT = _count(
    "BR-15",
    "SCD2 gap to the next version",
    "count(*)",
    "(select *, min(effective_from) over (partition by customer_id order by effective_from range between interval 1 day "
    "following and unbounded following) as next_from from v_customer_history) "
    "where not is_current and effective_to is not null and next_from > effective_to + 1",
    "WARN",
)

DQ_SUMMARY = [f"DQ-{n:02d}" for n in (1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 13, 18, 19, 21, 22)]
BR_SUMMARY = [f"BR-{n:02d}" for n in (1, 3, 5, 9, 10, 11, 13, 14)]
RUNNER = [f"RI-{n:02d}" for n in range(1, 11)] + [f"DQ-{n:02d}" for n in (9, 14, 15)] + DQ_SUMMARY + BR_SUMMARY


def _suites() -> dict[str, str]:
    each = checks()
    union = lambda ids: " union all ".join(each[i] for i in ids)
    verdict = "select rule_id, check_name, failed_rows, case when failed_rows = 0 then 'PASS' else {bad} end as status from ({rows})"
    return {
        "check_suite": union(sorted(each)),
        "fk_suite": " union all ".join(
            _count(rule, f"{child}.{column} -> {parent}", "count(*)", f"v_{child} where {column} not in (select {key} from v_{parent})", "FAIL")
            for rule, child, column, parent, key in FOREIGN_KEYS
        ),
        "check_suite_summary": f"""select count(*) as total, count(*) filter (status = 'PASS') as passed,
            count(*) filter (status = 'FAIL') as failed, count(*) filter (status = 'WARN') as warned,
            case when count(*) filter (status = 'FAIL') = 0 then 'PASS' else 'FAIL' end as overall from ({union(sorted(each))})""",
        "check_suite_runner": verdict.format(
            bad="case when rule_id like 'BR%' then 'WARN' else 'FAIL' end", rows=union(RUNNER)
        ),
        "dq_summary": verdict.format(bad="'FAIL'", rows=union(DQ_SUMMARY)),
        "br_summary": verdict.format(bad="'FAIL / WARN'", rows=union(BR_SUMMARY)),
        "report_6_integrity": " union all ".join(
            f"select check_name, failed_rows as orphan_rows, status as result from ({each[f'RI-{n:02d}']})" for n in range(1, 9)
        ),
    }


# The tables of each layer with their declared bytes per row.
OPERATIONAL = {
    "customer": 200,
    "contract": 50,
    "tariff": 80,
    "operator": 50,
    "device": 120,
    "location": 100,
    "region": 50,
    "event_type": 80,
    "channel": 50,
    "invoice": 56,
    "payment": 68,
    "cdr": 115,
}
WAREHOUSE = {
    "fact_usage_events": 135,
    "dim_customer": 220,
    "dim_time": 90,
    "dim_tariff": 120,
    "dim_event": 80,
    "dim_channel": 70,
    "dim_location": 115,
    "stg_cdr": 150,
}
DIMENSIONS = {
    "dim_time": "w_time",
    "dim_tariff": "w_tariff",
    "dim_event": "w_event",
    "dim_channel": "w_channel",
    "dim_location": "w_location",
}


def _counts(layer: str, tables: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{layer}' as layer, '{name}' as table_name, count(*) as row_count from {source}" for name, source in tables.items()
    )


def _reconciliation() -> dict[str, str]:
    source = {name: f"v_{name}" for name in OPERATIONAL}
    facts = {"fact_usage_events": "w_fact"}
    customers = {
        "dim_customer (all)": "w_customer",
        "dim_customer (current)": "w_customer where is_current",
        "dim_customer (historical)": "w_customer where not is_current",
    }
    snapshot = " union all ".join(
        [
            _counts("Business DB", {n: f"v_{n}" for n in ("customer", "contract", "cdr", "invoice", "payment")}),
            _counts("Staging", {f"stg_cdr ({s})": f"w_stg where etl_status = '{s}'" for s in ("VALID", "REJECTED")}),
            _counts("DWH", {"dim_customer (all)": "w_customer", "dim_customer (curr)": "w_customer where is_current"}),
            _counts("DWH", DIMENSIONS | facts),
        ]
    )
    layers = " union all ".join(
        [
            _counts("business_db", source),
            _counts("dwh", {"dim_customer": "w_customer"} | DIMENSIONS | facts | {"stg_cdr": "w_stg"}),
        ]
    )
    warehouse = facts | {"dim_customer": "w_customer"} | DIMENSIONS | {"stg_cdr": "w_stg"}
    kinds = {"dim_customer": "SCD2", "stg_cdr": "Staging"} | {name: "SCD1" for name in DIMENSIONS}
    sizes = " union all ".join(
        f"select '{layer}' as layer, '{name}' as table_name, '{kinds.get(name, '-')}' as scd_type, {width} as row_size_bytes, "
        f"count(*) as row_count, {width} * count(*) as total_bytes, round({width} * count(*) / 1048576.0::double, 2) as size_mb from {view}"
        for layer, views, widths in (("Operational DB", source, OPERATIONAL), ("Data Warehouse", warehouse, WAREHOUSE))
        for name, width in widths.items()
        for view in [views[name]]
    )
    totals = f"""select layer as database_layer, cast(sum(total_bytes) as bigint) as total_bytes from ({sizes}) group by layer
        union all select 'Index Overhead', cast(sum(total_bytes * 0.2::double) as bigint) from ({sizes})
        where table_name in ('cdr', 'fact_usage_events')"""
    return {
        "recon_ops_counts": _counts("Operational DB", source),
        "recon_dwh_counts": _counts("DWH Dimension", customers | DIMENSIONS | facts),
        "recon_layer_counts": f"""select *, cast(null as double) as pass_rate_pct from ({layers})
            union all select 'staging', 'valid', cast({VALID} as bigint), null from w_stg
            union all select 'staging', 'rejected', cast({REJECTED} as bigint), null from w_stg
            union all select 'staging', 'total', count(*), coalesce({_percent(VALID, 'count(*)')}, 0) from w_stg""",
        "report_3_snapshot": f"""select *, case table_name when 'stg_cdr (VALID)' then 'OK' when 'stg_cdr (REJECTED)'
            then case when row_count = 0 then 'OK' else 'WARN' end else '-' end as status from ({snapshot})""",
        "storage_footprint": sizes,
        "storage_totals": f"""with layers as ({totals}), everything as (select * from layers
            union all select 'TOTAL', cast(sum(total_bytes) as bigint) from layers)
            select *, round(total_bytes / 1048576.0::double, 1) as size_mb, round(total_bytes / 1073741824.0::double, 3) as size_gb
            from everything""",
    }


# table -> (key, required columns, value checks, further unique columns)
CONSTRAINTS = {
    "region": ("region_id", ["bundesland", "country"], {}, []),
    "operator": ("operator_id", ["operator_name", "country"], {}, []),
    "tariff": (
        "tariff_id",
        ["tariff_name", "tariff_type", "monthly_fee", "operator_id"],
        {"tariff_type": "tariff_type in ('Prepaid', 'Postpaid')"},
        [],
    ),
    "customer": (
        "customer_id",
        ["first_name", "last_name", "country", "segment", "customer_status"],
        {
            "gender": "gender in ('M', 'F', 'D')",
            "segment": "segment in ('Budget', 'Standard', 'Premium', 'Business', 'Senior')",
        },
        [],
    ),
    "device": ("device_id", ["customer_id"], {}, []),
    "contract": (
        "contract_id",
        ["customer_id", "tariff_id", "start_date", "status"],
        {"status": "status in ('Active', 'Closed', 'Suspended')"},
        [],
    ),
    "event_type": (
        "event_key",
        ["event_name", "event_category", "is_chargeable", "fraud_risk_level"],
        {"fraud_risk_level": "fraud_risk_level in ('Low', 'Medium', 'High', 'Critical')"},
        [],
    ),
    "channel": ("channel_id", ["channel_name", "channel_type"], {}, []),
    "location": ("location_id", ["country"], {"area_type": "area_type in ('Urban', 'Suburban', 'Rural')"}, ["cell_tower_id"]),
    "cdr": (
        "cdr_id",
        ["contract_id", "event_key", "event_datetime", "cost", "fraud_flag", "fraud_score"],
        {
            "duration_sec": "duration_sec >= 0",
            "call_type": "call_type in ('Outgoing', 'Incoming', 'N/A')",
            "fraud_score": "fraud_score between 0 and 1",
        },
        [],
    ),
    "payment": ("payment_id", ["contract_id", "amount", "pay_date"], {"amount": "amount >= 0"}, []),
    "invoice": (
        "invoice_id",
        ["contract_id", "billing_period", "total_amount", "status"],
        {"status": "status in ('Pending', 'Paid', 'Overdue', 'Cancelled')"},
        [],
    ),
}


# View, key (none for the fact, whose rows are not numbered there) and required columns of each warehouse table.
WAREHOUSE_CONSTRAINTS = {
    "dim_time": (
        "w_time",
        "time_key",
        "date_val day day_name week month month_name quarter year is_weekend holiday_flag time_of_day hour".split(),
    ),
    "dim_customer": ("w_customer", "customer_key", ["customer_id", "effective_from", "is_current"]),
    "dim_tariff": ("w_tariff", "tariff_key", ["tariff_id", "tariff_name", "tariff_type", "monthly_fee"]),
    "dim_event": ("w_event", "event_key", ["event_name", "event_category", "is_chargeable", "fraud_risk_level"]),
    "dim_channel": ("w_channel", "channel_key", ["channel_name", "channel_type"]),
    "dim_location": ("w_location", "location_key", ["location_id"]),
    "fact_usage_events": (
        "w_fact",
        None,
        (
            "customer_key time_key tariff_key event_key channel_key location_key call_count sms_count total_call_duration_sec"
            " total_data_volume_mb revenue_amount roaming_revenue international_revenue discount_amount fraud_score event_count"
        ).split(),
    ),
}


def _warehouse_constraints() -> str:
    lines = []
    for table, (view, key, required) in WAREHOUSE_CONSTRAINTS.items():
        head = f"select '{table}' as table_name, '{{name}}' as constraint_name, "
        lines += [head.format(name=f"not null {x}") + f"count(*) filter ({x} is null) as violations from {view}" for x in [*([key] if key else []), *required]]
        if key:
            lines.append(head.format(name=f"unique {key}") + f"(select count(*) from (select {key} from {view} where {key} is not null group by 1 having count(*) > 1))")
    return " union all ".join(lines)


GAP_DAYS = """select a.customer_id, a.effective_from, a.effective_to, min(b.effective_from) as next_from,
    min(b.effective_from) - a.effective_to as gap_days, any_value(a.n_versions) as n_versions
    from (select customer_id, effective_from, case when not is_current then effective_to end as effective_to, count(*) as n_versions
        from v_customer_history group by all) a
    join v_customer_history b on b.customer_id = a.customer_id and b.effective_from > a.effective_from
    group by a.customer_id, a.effective_from, a.effective_to having min(b.effective_from) - a.effective_to > 1"""


def _constraint_suite() -> str:
    lines = []
    for table, (key, required, values, unique) in CONSTRAINTS.items():
        head = f"select '{table}' as table_name, '{{name}}' as constraint_name, count(*) as violations from "
        for column in [key, *required]:
            lines.append(head.format(name=f"not null {column}") + f"v_{table} where {column} is null")
        for column, condition in values.items():
            lines.append(head.format(name=f"check {column}") + f"v_{table} where not ({condition})")
        for column in [key, *unique]:
            copies = f"(select {column} from v_{table} where {column} is not null group by {column} having count(*) > 1)"
            lines.append(head.format(name=f"unique {column}") + copies)
    return " union all ".join(lines)


def statements() -> dict[str, str]:
    bodies = MAIN | _suites() | _reconciliation() | {
        "constraint_suite": _constraint_suite(),
        "constraint_suite_dwh": _warehouse_constraints(),
        "br_15_adjacent": ADJACENT,
        "scd2_gap_days": GAP_DAYS,
        "active_contract_join_binned": MAIN["active_contract_join"],
    }
    bodies["scd2_apply_changes"] = MAIN["scd2_apply"]
    bodies["ri_by_key"] = " union all ".join(f"({checks()[rule]})" for rule in ("RI-07", "BR-11", "RI-08", "RI-09", "RI-10", "BR-10"))
    on_history = checks("v_customer_history")
    for rule, body in checks().items():
        name = rule.lower().replace("-", "_")
        bodies[name] = on_history[rule] if rule in ("DQ-18", "DQ-19", "BR-15") else body
    out = {}
    for name, body in bodies.items():
        if body.startswith("with "):
            out[name] = _statement(body).replace("\nwith ", ",\n", 1)
        else:
            out[name] = _statement(body)
    return out
