"""Telecom-shaped views over the generated test tables.

Every view reads its whole source tables. Dirt (NULLs, orphans, repeats, bad ranges) is put into column
values by key arithmetic; rows are only left out where the data itself says so (an account not yet open,
an unpaid invoice). The same declaration yields the Spark frame and the text of a SQL common table
expression, so both engines start from the same input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class View:
    source: str
    columns: dict[str, str]
    joins: tuple[tuple[str, str], ...] = field(default=())
    where: str | None = None

    def frame(self, read: Callable[[str], DataFrame], folder: str) -> DataFrame:
        df = read(f"{folder}/{self.source}.parquet")
        for table, condition in self.joins:
            df = df.join(read(f"{folder}/{table}.parquet"), F.expr(condition))
        if self.where:
            df = df.where(self.where)
        return df.selectExpr(*[f"{text} as {name}" for name, text in self.columns.items()])

    def sql(self) -> str:
        columns = ", ".join(f"{text} as {name}" for name, text in self.columns.items())
        joins = "".join(f" join {table} on {condition}" for table, condition in self.joins)
        where = f" where {self.where}" if self.where else ""
        return f"select {columns} from {self.source}{joins}{where}"


SEGMENT = (
    "case when c_custkey % 101 = 0 then 'Unknown' when c_mktsegment = 'MACHINERY' then 'Budget' "
    "when c_mktsegment = 'BUILDING' then 'Standard' when c_mktsegment = 'AUTOMOBILE' then 'Premium' "
    "when c_mktsegment = 'FURNITURE' then 'Business' else 'Senior' end"
)

CUSTOMER = {
    "customer_id": "cast(c_custkey + 1 as int)",
    "first_name": "case when c_custkey % 113 = 0 then null else c_name end",
    "last_name": "n_name",
    "gender": "case when c_custkey % 3 = 0 then 'M' when c_custkey % 3 = 1 then 'F' else 'D' end",
    "birth_date": "date '1960-01-01' + cast(c_custkey % 15000 as int)",
    "age": "cast(18 + c_custkey % 60 as int)",
    "profession": "'Job ' || cast(c_custkey % 5 as varchar(4))",
    "city": "n_name",
    "country": "'Testland'",
    "region_id": "cast(n_regionkey + 1 as int)",
    "segment": SEGMENT,
    "customer_status": "'Active'",
}
HOME_NATION = (("nation", "n_nationkey = c_nationkey"),)

# Second snapshot: some customers changed a tracked attribute (profession, segment) or only their city.
CUSTOMER_CHANGED = CUSTOMER | {
    # Low balances have signed up again under a new number, which is a new entity of the second load.
    "customer_id": "cast(case when c_acctbal < -200 then 1000000000 + c_custkey else c_custkey + 1 end as int)",
    "profession": "'Job ' || cast((c_custkey + case when c_custkey % 11 = 0 then 1 else 0 end) % 5 as varchar(4))",
    "city": "n_name || case when c_custkey % 4 = 0 then ' II' else '' end",
    "segment": f"case when c_custkey % 7 = 0 then 'Standard' else {SEGMENT} end",
}

VIEWS: dict[str, View] = {
    "v_region": View("region", {"region_id": "cast(r_regionkey + 1 as int)", "bundesland": "r_name", "country": "'Testland'"}),
    "v_operator": View(
        "region",
        {"operator_id": "cast(r_regionkey + 1 as int)", "operator_name": "r_name || ' Net'", "country": "'Testland'"},
    ),
    "v_tariff": View(
        "part",
        {
            "tariff_id": "cast(2001 + p_partkey as int)",
            "tariff_name": "'Plan ' || cast(p_partkey as varchar(12))",
            "tariff_type": "case when p_partkey % 20 = 7 then 'Hybrid' when p_partkey % 2 = 0 then 'Prepaid' else 'Postpaid' end",
            "monthly_fee": "cast(case when p_partkey % 50 = 9 then -1 else p_size end as decimal(8,2))",
            "free_minutes": "cast(case when p_partkey % 4 = 3 then null else p_size % 7 * 10 end as int)",
            "free_sms": "cast(p_size * 5 as int)",
            "data_mb": "cast(case when p_partkey % 4 = 3 then null else p_size * 100 end as int)",
            "operator_id": "cast(p_partkey % 6 + 1 as int)",
        },
    ),
    "v_customer": View("customer", CUSTOMER, HOME_NATION),
    "v_customer_day1": View("customer", CUSTOMER, HOME_NATION),
    "v_customer_day2": View("customer", CUSTOMER_CHANGED, HOME_NATION, "c_acctbal <= 9400"),  # the rest has left
    # Versions shaped like the customer dimension, one per order, with gaps, overlaps and several current ones.
    "v_customer_history": View(
        "orders",
        {
            "customer_key": "o_orderkey + 1",
            "customer_id": "cast(o_custkey + 1 as int)",
            "effective_from": "cast(o_orderdate as date)",
            "effective_to": "case when o_orderstatus = 'O' then null else cast(o_orderdate as date) + cast(o_orderkey % 400 - 5 as int) end",
            "is_current": "o_orderstatus = 'O'",
        },
    ),
    "v_device": View(
        "supplier",
        {
            "device_id": "cast(3000 + s_suppkey as int)",
            "customer_id": "cast(case when s_suppkey % 9 = 8 then null when s_suppkey % 7 = 6 then -9 else s_suppkey + 1 end as int)",
            "manufacturer": "'Maker ' || cast(s_suppkey % 7 as varchar(4))",
            "device_type": "case when s_suppkey % 5 = 0 then 'Tablet' else 'Smartphone' end",
        },
    ),
    "v_location": View(
        "supplier",
        {
            "location_id": "cast(s_suppkey as int)",
            "country": "'Testland'",
            "region": "r_name",
            "city": "n_name",
            "cell_tower_id": "'CT_' || cast(s_suppkey as varchar(12))",
            "area_type": "case when s_suppkey % 3 = 0 then 'Urban' when s_suppkey % 3 = 1 then 'Suburban' else 'Rural' end",
            "latitude": "cast(46.37 + (s_suppkey % 40) * 0.1 as decimal(9,6))",
            "longitude": "cast(9.53 + (s_suppkey % 30) * 0.2 as decimal(9,6))",
        },
        (("nation", "n_nationkey = s_nationkey"), ("region", "r_regionkey = n_regionkey")),
    ),
    "v_contract": View(
        "customer",
        {
            "contract_id": "cast(c_custkey as int)",
            "customer_id": "cast(case when c_custkey % 50 = 49 then c_custkey else c_custkey + 1 end as int)",
            "tariff_id": "cast(case when c_custkey % 97 = 5 then -5 else 2001 + floor(c_custkey / 10) end as int)",
            "start_date": "date '2024-01-01' + cast(c_custkey % 31 as int)",
            "end_date": "case when c_custkey % 10 = 0 then date '2024-01-01' + cast(c_custkey % 31 + c_custkey % 40 - 5 as int) else null end",
            "status": "case when c_custkey % 10 < 2 then 'Closed' when c_custkey % 10 = 2 then 'Suspended' else 'Active' end",
        },
    ),
    "v_event_type": View(
        "part",
        {
            "event_key": "cast(p_partkey as int)",
            "event_name": "'Event ' || cast(p_partkey as varchar(12))",
            "event_category": "p_type",
            "is_chargeable": "p_partkey in (1, 2, 3, 4, 7)",
            "fraud_risk_level": "case when p_partkey % 10 = 9 then 'Critical' when p_partkey % 10 in (4, 7, 8) then 'High' else 'Low' end",
        },
    ),
    "v_channel": View(
        "nation",
        {
            "channel_id": "cast(n_nationkey + 1 as int)",
            "channel_name": "n_name",
            "channel_type": "case when n_nationkey % 5 = 0 then 'Digital' else 'Network' end",
        },
    ),
    "v_invoice": View(
        "orders",
        {
            "invoice_id": "o_orderkey",
            "contract_id": "cast(case when o_orderkey % 331 = 0 then -1 else o_custkey end as int)",
            "billing_period": "substr(cast(cast(o_orderdate as date) as varchar(10)), 1, 7)",
            "total_amount": "cast(case when o_orderkey % 997 = 0 then 0 else o_totalprice end as decimal(10,2))",
            "status": "case when o_orderstatus = 'F' then 'Paid' when o_orderstatus = 'O' then 'Pending' else 'Overdue' end",
        },
    ),
    "v_payment": View(
        "orders",
        {
            "payment_id": "o_orderkey",
            "contract_id": "cast(o_custkey as int)",
            "invoice_id": "case when o_orderkey % 401 = 0 then -1 else o_orderkey end",
            "amount": "cast(cast(o_totalprice as decimal(10,2)) * case when o_orderkey % 20 = 0 then 1.10 else 1.00 end as decimal(10,2))",
            "pay_date": "cast(o_orderdate as date)",
            "method": "case when o_orderkey % 3 = 0 then 'Card' else 'Transfer' end",
        },
        (),
        "o_orderstatus <> 'O'",  # an open order is an unpaid invoice
    ),
    "v_cdr": View(
        "events",
        {
            "cdr_id": "case when event_id % 500 = 499 then event_id - 1 else event_id end",
            "src_seq": "event_id",
            "contract_id": "cast(case when event_id % 307 = 0 then null when event_id % 311 = 0 then -1 - user_id else user_id end as int)",
            "receiver_id": "cast(event_id % 1000 as int)",
            "event_key": (
                "cast(case when event_id % 211 = 0 then null when event_id % 223 = 0 then -3 "
                "when event_type = 'click' then case when event_id % 5 = 0 then 7 else 1 end "
                "when event_type = 'view' then case when event_id % 3 = 0 then 2 else 3 end "
                "when event_type = 'purchase' then 4 when event_type = 'signup' then 10 else 11 end as int)"
            ),
            "event_datetime": "case when event_id % 401 = 0 then null else ts end",
            "duration_sec": (
                "cast(case when event_id % 97 = 0 then -5 when event_type = 'click' then event_id % 900 "
                "when event_type = 'error' then 1 + event_id % 4 when event_id % 89 = 0 then null else 0 end as int)"
            ),
            "data_volume_mb": (
                "cast(case when event_type = 'view' and event_id % 3 <> 0 and event_id % 83 <> 0 then value "
                "when event_id % 101 = 0 then -1 else 0 end as decimal(12,4))"
            ),
            "location_id": (
                "cast(case when event_id % 53 = 0 then null when event_id % 59 = 0 then -7 "
                "when event_id % 4 = 0 then event_id % 10 else user_id >> 1 end as int)"
            ),
            "cost": "cast(value - 0.05 as decimal(10,4))",
            "call_type": (
                "case when event_type = 'click' then 'Outgoing' when event_id % 503 = 0 then 'Bogus' "
                "when event_id % 2 = 0 then 'Incoming' else 'N/A' end"
            ),
            "fraud_flag": "event_id % 29 = 0",
            "fraud_score": "cast(case when event_id % 307 = 1 then null else cast(event_id * 37 % 103 as double) / 100 end as decimal(5,2))",
            "fraud_scenario": "case when event_id % 29 = 0 then 'S' || cast(event_id % 5 as varchar(4)) else null end",
        },
    ),
}
