"""Operators on small hand-made rows, including the cases the test tables do not hold."""

from __future__ import annotations

from datetime import date, datetime
from itertools import product

import pytest
from pyspark.sql import functions as F

from tidewell.functions.calendar import HOLIDAYS_2024, calendar, easter_sunday, holidays_of, time_key
from tidewell.operators import dimensions, intervals, rollup
from tidewell.operators.dedup import keep_first, mark_repeats
from tidewell.operators.keys import next_after, number_by_id, number_sorted
from tidewell.operators.rules import Reference, Rule, check_references, check_rows, summarize
from tidewell.operators.validate import pass_rate, report, split, stage, validate
from tidewell.session import scratch_root

CDR = (
    "cdr_id bigint, src_seq bigint, contract_id int, event_key int, event_datetime timestamp_ntz, duration_sec int, "
    "data_volume_mb decimal(12,4), location_id int, cost decimal(10,4), fraud_score decimal(5,2)"
)


def usage(spark, *changes: dict):
    from decimal import Decimal

    good = {
        "cdr_id": 1,
        "contract_id": 7,
        "event_key": 1,
        "event_datetime": datetime(2024, 3, 5, 13, 30),
        "duration_sec": 60,
        "data_volume_mb": Decimal("1.5"),
        "location_id": 4,
        "cost": Decimal("0.125"),
        "fraud_score": Decimal("0.10"),
    }
    rows = [good | {"cdr_id": i + 1, "src_seq": i} | change for i, change in enumerate(changes)]
    names = [part.split()[0] for part in CDR.replace("(12,4)", "").replace("(10,4)", "").replace("(5,2)", "").split(", ")]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], CDR)


def statuses(df):
    return {row.src_seq: row.etl_status for row in df.collect()}


def test_validation_rules(spark):
    batch = usage(
        spark,
        {},
        {"contract_id": None},
        {"event_key": None},
        {"event_datetime": None},
        {"duration_sec": -1},
        {"duration_sec": None},
        {"data_volume_mb": None},
        {"fraud_score": None},
        {"cost": None},
    )
    expected = ["VALID", "REJECTED", "REJECTED", "REJECTED", "REJECTED", "VALID", "VALID", "REJECTED", "VALID"]
    assert statuses(validate(batch)) == dict(enumerate(expected))


def test_first_copy_stays_even_if_it_is_bad_and_null_ids_are_copies(spark):
    batch = usage(
        spark, {"cdr_id": 5, "contract_id": None}, {"cdr_id": 5}, {"cdr_id": None}, {"cdr_id": None}, {"cdr_id": 6}
    )
    assert statuses(validate(batch)) == {0: "REJECTED", 1: "REJECTED", 2: "VALID", 3: "REJECTED", 4: "VALID"}
    lines = {row.rule: (row.passed, row.failed) for row in report(batch).collect()}
    assert lines["no_duplicate_cdr_id"] == (3, 2)
    assert lines["not_null_contract_id"] == (4, 1)


def test_valid_and_rejected_make_up_the_batch(spark):
    batch = stage(usage(spark, {}, {"cost": None}, {"fraud_score": None}, {"cdr_id": 1}), date(2024, 3, 6))
    marked = validate(batch)
    valid, rejected = split(marked)
    assert valid.count() + rejected.count() == batch.count()
    assert pass_rate(marked).collect()[0].asDict() == {
        "total_rows": 4,
        "valid_rows": 2,
        "rejected_rows": 2,
        "pass_pct": 50.0,
    }


def test_empty_batch(spark):
    empty = stage(usage(spark, {}).where("false"), date(2024, 3, 6))
    assert validate(empty).count() == 0
    assert pass_rate(validate(empty)).collect()[0].pass_pct == 0.0
    assert {row.failed for row in report(empty).collect()} == {0}


def test_hot_id_is_marked_like_the_rest(spark):
    n = 30_000
    ids = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    rows = spark.range(n).select(ids.alias("k"), F.col("id").alias("seq"))
    marked = mark_repeats(rows, ["k"], "seq", "copy")
    assert marked.count() == n
    assert marked.where("copy").count() == n // 3 - 1
    assert marked.where("k = -1 and not copy").collect()[0].seq == 0


def test_keep_first_collapses_exact_copies(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "z"), (None, 3, "c"), (None, 4, "a")], "k int, o int, v string")
    assert {tuple(r) for r in keep_first(rows, ["k"], ["o"]).collect()} == {(1, 1, "z"), (None, 3, "c")}


def test_a_hot_key_is_marked_and_reduced_alike_without_broadcasts(spark):
    rows = spark.range(3000).selectExpr("id as seq", "case when id % 3 = 0 then 7 else id end as k", "id % 5 as v")
    expected = {(r.seq, r.late) for r in mark_repeats(rows, ["k"], "seq", "late").collect()}
    assert sum(late for _, late in expected) == 1000
    kept = {tuple(r) for r in keep_first(rows, ["k"], ["v", "seq"]).collect()}
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {(r.seq, r.late) for r in mark_repeats(rows, ["k"], "seq", "late").collect()} == expected
        assert {tuple(r) for r in keep_first(rows, ["k"], ["v", "seq"]).collect()} == kept
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert len(kept) == 2000 and (0, 7, 0) in kept
    plan = keep_first(rows, ["k"], ["v"])._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan


def test_holiday_rules_give_the_fixed_list():
    assert holidays_of(2024) == HOLIDAYS_2024
    assert [easter_sunday(year) for year in (2019, 2025, 2038)] == [date(2019, 4, 21), date(2025, 4, 20), date(2038, 4, 25)]


def test_keys_are_consecutive(spark):
    ids = spark.range(0, 5000, 7).select((F.col("id") - 100).cast("int").alias("id"))
    numbered = number_by_id(ids, "id", "key", 40, width=64).orderBy("id").collect()
    assert [row.key for row in numbered] == list(range(41, 41 + len(numbered)))
    pairs = spark.range(3000).select((F.col("id") % 3 == 0).alias("hot"), F.hash("id").alias("h"), "id")
    sorted_keys = number_sorted(pairs, ["hot", "h", "id"], "key", 5)
    rows = sorted_keys.orderBy("hot", "h", "id").collect()
    assert [row.key for row in rows] == list(range(6, 3006))
    assert next_after_value(spark, [-1]) == 0 and next_after_value(spark, [3, 9]) == 9 and next_after_value(spark, []) == 0


def next_after_value(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "key bigint")
    return spark.range(1).select(next_after(df, "key").alias("seed")).collect()[0].seed


def test_time_key_and_calendar(spark):
    moments = [datetime(2024, 1, 1, h) for h in (0, 5, 6, 11, 12, 17, 18, 23)]
    df = spark.createDataFrame([(m,) for m in moments], "m timestamp_ntz")
    assert [r.k % 100 for r in df.select(time_key(F.col("m")).alias("k")).collect()] == [0, 0, 6, 6, 12, 12, 18, 18]
    year = calendar(spark, date(2024, 1, 1), date(2024, 12, 31))
    total = year.agg(F.count("*"), F.sum("week"), F.sum("quarter"), F.count_if("is_weekend"), F.sum("time_key"), F.count_if("holiday_flag"))
    assert tuple(total.collect()[0]) == (1464, 38592, 3668, 416, 2963233679976, 48)


CUSTOMER = (
    "customer_id int, first_name string, last_name string, gender string, birth_date date, age int, profession string, "
    "city string, country string, segment string, customer_status string"
)


def snapshot(spark, *people):
    rows = [(i, "A", "B", "D", date(1980, 1, 1), 44, job, city, "X", segment, "Active") for i, job, segment, city in people]
    return spark.createDataFrame(rows, CUSTOMER)


def versions(df):
    return sorted(
        (r.customer_id, r.customer_key, r.profession, r.city, str(r.effective_from), str(r.effective_to), r.is_current)
        for r in df.collect()
    )


def test_version_history(spark):
    unknown = dimensions.unknown_customer(spark)
    one = snapshot(spark, (1, "cook", "Budget", "P"), (2, None, "Budget", "P"), (3, "smith", "Senior", "P"))
    first = dimensions.apply_versions(unknown, one, date(2024, 1, 1))
    assert versions(first) == versions(dimensions.first_versions(unknown, one, date(2024, 1, 1)))
    two = snapshot(spark, (1, "baker", "Budget", "Q"), (2, None, "Budget", "Q"), (4, "miner", "Premium", "P"))
    assert dimensions.version_activity(first, two).collect()[0].asDict() == {"closed": 1, "inserted": 2}
    second = dimensions.apply_versions(first, two, date(2024, 2, 1))
    assert versions(second) == [
        (-1, -1, "Unknown", "Unknown", "2000-01-01", "None", True),
        (1, 1, "cook", "P", "2024-01-01", "2024-01-31", False),
        (1, 4, "baker", "Q", "2024-02-01", "None", True),
        (2, 2, None, "P", "2024-01-01", "None", True),  # only the city moved
        (3, 3, "smith", "P", "2024-01-01", "None", True),  # missing from the source
        (4, 5, "miner", "P", "2024-02-01", "None", True),
    ]
    again = dimensions.apply_versions(second, two, date(2024, 3, 1))
    assert versions(again) == versions(second)
    same_day = dimensions.apply_versions(second, snapshot(spark, (1, "cook", "Budget", "Q")), date(2024, 2, 1))
    assert same_day.where("effective_to < effective_from").count() == 1
    assert dimensions.ambiguous_entities(same_day).count() == 0
    assert dimensions.ambiguous_entities(same_day.unionByName(second.where("customer_id = 3"))).collect()[0].customer_id == 3


def test_duplicate_entities_in_a_source_collapse(spark):
    source = snapshot(spark, (1, "cook", "Budget", "P"), (1, "baker", "Budget", "P"))
    assert [r.profession for r in dimensions.one_per_entity(source).collect()] == ["baker"]


def test_overwrite_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "key int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "key int, v string")
    assert sorted(map(tuple, dimensions.overwrite_by_key(old, new, "key").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_rollup_and_colliding_contracts(spark):
    rows = usage(
        spark,
        {},
        {"duration_sec": None, "cost": None},
        {"event_key": 2},
        {"contract_id": 8},
        {"location_id": None},
        {"cdr_id": None},
        {"contract_id": 99},
    )
    rolled = rollup.usage_rollup(rows)
    assert rolled.agg(F.sum("event_count")).collect()[0][0] == 5  # one row has no id, one no location
    contract = spark.createDataFrame([(7, 2005, 1), (8, 2005, 1)], "contract_id int, tariff_id int, customer_id int")
    customers = spark.createDataFrame([(11, 1, True), (10, 1, False)], "customer_key bigint, customer_id int, is_current boolean")
    fact = rollup.resolve_keys(rolled, contract, customers)
    lines = {(r.contract_id, r.event_key): r for r in fact.collect()}
    assert (lines[7, 1].customer_key, lines[7, 1].tariff_key, lines[7, 1].call_count) == (11, 2005, 3)
    assert (lines[99, 1].customer_key, lines[99, 1].tariff_key) == (-1, 2001)
    assert lines[7, 1].total_call_duration_sec == 120 and str(lines[7, 1].revenue_amount) == "0.25"
    assert lines[7, 2].sms_count == 1 and lines[7, 2].call_count == 0
    merged = rollup.at_declared_grain(fact)
    assert fact.groupBy(*rollup.GRAIN).count().where("count > 1").count() == 1
    assert merged.groupBy(*rollup.GRAIN).count().where("count > 1").count() == 0
    assert merged.agg(F.sum("event_count")).collect()[0][0] == 5


def test_point_in_time_version(spark):
    rolled = rollup.usage_rollup(usage(spark, {}, {"event_datetime": datetime(2024, 3, 1, 0, 0)}, {"event_datetime": datetime(2023, 1, 1)}))
    contract = spark.createDataFrame([(7, 2005, 1)], "contract_id int, tariff_id int, customer_id int")
    spans = [(10, 1, date(2024, 1, 1), date(2024, 3, 4), False), (11, 1, date(2024, 3, 5), None, True)]
    customers = spark.createDataFrame(spans, "customer_key bigint, customer_id int, effective_from date, effective_to date, is_current boolean")
    fact = rollup.resolve_keys_at_event(rolled, contract, customers)
    assert {r.time_key: r.customer_key for r in fact.collect()} == {2024030512: 11, 2024030100: 10, 2023010100: -1}


def brute_gaps(rows, adjacent):
    found = 0
    for entity, start, end, current in rows:
        if current or end is None:
            continue
        later = sorted(s for e, s, _, _ in rows if e == entity and s > start)
        later = later[:1] if adjacent else later
        found += sum(1 for s in later if (s - end).days > 1)
    return found


def test_version_gaps_match_brute_force(spark):
    day = lambda n: date.fromordinal(738000 + n)
    rows = [
        (e, day(s % 41), None if s % 7 == 0 else day(s % 41 + s * e % 23 - 3), s % 5 == 0)
        for e, s in product(range(1, 5), range(0, 120, 3))
    ]
    df = spark.createDataFrame(rows, "customer_id int, effective_from date, effective_to date, is_current boolean")
    total = lambda d: d.agg(F.coalesce(F.sum("violations"), F.lit(0))).collect()[0][0]
    assert total(intervals.later_version_gaps(df)) == brute_gaps(rows, False) > 0
    assert total(intervals.adjacent_version_gaps(df)) == brute_gaps(rows, True) > 0


def test_three_versions_with_one_gap(spark):
    rows = [(1, date(2024, 1, 1), date(2024, 1, 31), False), (1, date(2024, 2, 1), date(2024, 2, 29), False), (1, date(2024, 3, 10), None, True)]
    df = spark.createDataFrame(rows, "customer_id int, effective_from date, effective_to date, is_current boolean")
    assert intervals.adjacent_version_gaps(df).collect()[0].violations == 1
    assert intervals.later_version_gaps(df).collect()[0].violations == 2  # the first version also misses the third


def test_following_start_is_lead(spark):
    from pyspark.sql import Window

    rows = spark.range(400).select(
        (F.col("id") % 3).alias("customer_id"), F.col("id").alias("contract_id"), F.date_add(F.lit(date(2024, 1, 1)), (F.hash("id") % 20).cast("int")).alias("start_date")
    )
    ours = intervals.following_start(rows, "customer_id", "start_date", "contract_id", "n")
    plain = rows.withColumn("n", F.lead("start_date").over(Window.partitionBy("customer_id").orderBy("start_date", "contract_id")))
    assert ours.exceptAll(plain.select(*ours.columns)).count() == 0 and ours.count() == 400


def test_billing_months_skip_spans_that_end_before_they_start(spark):
    rows = [(1, 1, 1, date(2024, 1, 20), date(2024, 3, 2)), (2, 1, 1, date(2024, 5, 1), date(2024, 4, 1)), (3, 1, 1, date(2024, 12, 5), None)]
    df = spark.createDataFrame(rows, "contract_id int, customer_id int, tariff_id int, start_date date, end_date date")
    due = sorted((r.contract_id, r.due_month) for r in intervals.billing_months(df, "2024-12-31").collect())
    assert due == [(1, date(2024, 1, 1)), (1, date(2024, 2, 1)), (1, date(2024, 3, 1)), (3, date(2024, 12, 1))]


def test_rules_and_references(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (9, None)], "k int, v string")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "p int")
    rules = [
        Rule("A", "not in list", "v not in ('a', 'b')"),  # NULL is neither in nor out
        Rule("B", "null key", "k is null", "WARN"),
        Rule("C", "enough rows", "true", passes="failed_rows >= 4"),
        Rule("D", "copies", measure="count(*) - count(distinct k)"),
    ]
    rows = {r.rule_id: (r.failed_rows, r.status) for r in check_rows(child, rules).collect()}
    assert rows == {"A": (1, "FAIL"), "B": (1, "WARN"), "C": (4, "PASS"), "D": (1, "FAIL")}
    refs = [Reference("R1", "k", "k", "parent", "p"), Reference("R2", "k again", "k", "all", "k")]
    found = check_references(child, refs, {"parent": parent, "all": child})
    assert {r.rule_id: r.failed_rows for r in found.collect()} == {"R1": 2, "R2": 1}
    empty = check_references(child.where("false"), refs, {"parent": parent, "all": child})
    assert {(r.failed_rows, r.status) for r in empty.collect()} == {(0, "PASS")}
    assert summarize(check_rows(child, rules)).collect()[0].overall == "FAIL"
    assert summarize(check_rows(child, rules[1:3])).collect()[0].overall == "PASS"


def test_hot_foreign_key_counts_every_row(spark):
    child = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("id")).alias("k"))
    parent = spark.range(9000).where("id <> 77").withColumnRenamed("id", "p")
    found = check_references(child, [Reference("R", "k", "k", "parent", "p")], {"parent": parent})
    assert found.collect()[0].failed_rows == 3001


def test_scratch_folder_must_be_shared_on_a_cluster(spark):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda name, default: None)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        scratch_root(Elsewhere)
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_the_newest_row_of_an_entity_is_kept(spark):
    rows = [(1, "a", date(2024, 1, 1)), (1, "b", date(2024, 3, 1)), (1, "c", None), (2, "z", None), (2, "y", None), (3, "x", date(2023, 1, 1))]
    df = spark.createDataFrame(rows, "customer_id int, segment string, created_at date")
    for parts in (1, 3):
        kept = dimensions.one_per_entity(df.repartition(parts), newest_by="created_at")
        assert sorted(tuple(x) for x in kept.select("customer_id", "segment").collect()) == [(1, "b"), (2, "y"), (3, "x")]


def test_gap_days(spark):
    day = date(2024, 1, 1)
    rows = [
        (1, day, date(2024, 1, 9), False),
        (1, date(2024, 1, 10), date(2024, 1, 15), False),  # follows at once
        (1, date(2024, 1, 20), None, True),
        (2, day, date(2024, 1, 3), False),
        (2, day, date(2024, 1, 3), False),
        (2, date(2024, 2, 1), None, True),
        (3, day, None, True),
    ]
    df = spark.createDataFrame(rows, "customer_id int, effective_from date, effective_to date, is_current boolean")
    found = sorted(tuple(x) for x in intervals.version_gaps(df).collect())
    assert found == [
        (1, date(2024, 1, 10), date(2024, 1, 15), date(2024, 1, 20), 5, 1),
        (2, day, date(2024, 1, 3), date(2024, 2, 1), 29, 2),
    ]


@pytest.mark.parametrize("bin_days", [1, 7, 400])
def test_binned_interval_join_equals_the_plain_one(spark, bin_days):
    """Open and empty spans, spans before and after all events, events without a key or a date, and overlapping spans."""
    first = date(2023, 1, 1).toordinal()
    spans = [(k, date.fromordinal(first + s), date.fromordinal(first + s + n) if n is not None else None) for k, s, n in
             [(1, 0, 10), (1, 5, 30), (1, 36, None), (2, 100, -5), (2, -900, 20), (3, 4000, None), (4, 0, None)]]
    events = [(i, i % 5 or None, datetime(2023, 1, 1 + i % 28, 5)) for i in range(90)] + [(900, 1, None), (901, 1, datetime(2023, 6, 1))]
    left = spark.createDataFrame(events, "event_id int, k int, moment timestamp")
    right = spark.createDataFrame(spans, "k int, since date, until date")
    for how in ("inner", "left"):
        found = [intervals.within_validity(left, right, "k", "moment", "since", "until", how, x) for x in (None, bin_days)]
        assert found[0].columns == found[1].columns
        assert sorted(map(repr, found[0].collect())) == sorted(map(repr, found[1].collect()))
    assert intervals.within_validity(left.where("false"), right, "k", "moment", "since", "until", "left", bin_days).count() == 0


def test_a_hot_key_is_spread_by_bins(spark):
    """A contract with a third of the events and 1,000 versions: no task has more than a small part of its rows."""
    hot = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) as k", "timestamp '2021-01-01' + make_interval(0, 0, 0, cast(id % 1000 as int)) as moment")
    versions = spark.range(1000).selectExpr("if(id >= 0, -1, id) as k", "date_add(date '2021-01-01', cast(id as int)) as since", "date_add(date '2021-01-01', cast(id as int)) as until")
    kept = {x: spark.conf.get(x) for x in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sizes = []
        for bin_days in (None, 8):
            joined = intervals.within_validity(hot, versions, "k", "moment", "since", "until", "inner", bin_days)
            by_task = joined.groupBy(F.spark_partition_id()).count().collect()
            sizes.append(sorted(x["count"] for x in by_task))
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert sum(sizes[0]) == sum(sizes[1]) == 10_000
    assert sizes[0] == [10_000] and max(sizes[1]) < 4_500
