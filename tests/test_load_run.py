"""Warehouse tables and the window load on the smallest test set."""

from __future__ import annotations

import random
import threading
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidewell.operators.rollup import GRAIN, MEASURES
from tidewell.plans import checks, load_run, marts, reports
from tidewell.plans.checks import Bounds
from tidewell.plans.fixture_tables import FixtureTables
from tidewell.session import scratch_root
from tidewell.sources.files import read_parquet, write_csv, write_parquet_stamped
from tidewell.sources.snapshots import CommitConflict, SnapshotTable
from tidewell.sources.tables import Warehouse, query

OPERATIONAL = ("region", "operator", "tariff", "customer", "device", "contract", "location", "payment", "invoice")
BOUNDS = Bounds(date(2024, 6, 1), date(2024, 1, 1), date(2024, 12, 31))
WEEK = (date(2024, 1, 8), date(2024, 1, 14))


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir, tmp_path_factory):
    house = Warehouse(spark, str(tmp_path_factory.mktemp("house")), "t_", buckets=8)
    tables = FixtureTables(spark, sf_dir)
    load_run.prepare(house, tables["event_type"], tables["channel"])
    for name in OPERATIONAL:
        house.append(tables[name], name)
    house.append(tables["cdr"].drop("src_seq"), "cdr")
    yield house
    for layer in ("t_ops", "t_dwh"):
        spark.sql(f"drop schema if exists {layer} cascade")


def facts(house, keys=False):
    columns = (["usage_event_key"] if keys else []) + GRAIN + MEASURES
    return sorted(map(tuple, house.read("fact_usage_events").select(*columns).collect()))


def test_load_repeat_and_overlap(warehouse, spark):
    audit = load_run.run(warehouse, *WEEK, run_id="w1")
    staged = warehouse.read("stg_cdr")
    assert audit["extracted"] == staged.count() == audit["valid"] + audit["rejected"] > 0
    assert audit["fact_rows"] == warehouse.count("fact_usage_events")
    keys = sorted(r[0] for r in warehouse.read("fact_usage_events").select("usage_event_key").collect())
    assert keys == list(range(1, len(keys) + 1))
    counted = warehouse.read("fact_usage_events").agg(F.sum("event_count")).collect()[0][0]
    assert counted == audit["valid"] - audit["valid_without_location"]
    assert warehouse.count("dim_time") == 1464
    assert audit["orphans"] == {"fact -> dim_time orphans": 0, "fact -> dim_customer orphans": 0} and audit["suite"]["total"] == 36

    before, people = facts(warehouse), warehouse.count("dim_customer")
    again = load_run.run(warehouse, *WEEK, run_id="w1 again")
    assert facts(warehouse) == before and warehouse.count("dim_customer") == people
    assert again["fact_rows"] == audit["fact_rows"] and warehouse.count("etl_audit") == 2

    load_run.run(warehouse, date(2024, 1, 15), date(2024, 1, 21), run_id="w2")
    assert set(before) < set(facts(warehouse))
    keys = [r[0] for r in warehouse.read("fact_usage_events").select("usage_event_key").collect()]
    assert len(keys) == len(set(keys))

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    orphans = load_run.verify(warehouse)
    assert orphans == {"fact -> dim_time orphans": 0, "fact -> dim_customer orphans": 0}
    results, summary = load_run.run_suite(warehouse, BOUNDS)
    assert summary["total"] == 36 == results.count() and summary["overall"] == "FAIL"
    tables = load_run.WarehouseTables(warehouse)
    assert marts.revenue_by_tariff(tables).count() > 0
    assert reports.table_snapshot(tables).count() == 15
    assert reports.staging_status(tables).agg(F.sum("pct")).collect()[0][0] == pytest.approx(100)


def test_loads_leave_nothing_behind(warehouse, spark):
    def folders():
        tables = sorted(str(x.relative_to(root)) for x in root.glob("*/*/v-*"))
        cuts = sorted(Path(scratch_root(spark).removeprefix("file://")).iterdir())
        return Counter(x.rsplit("/", 1)[0] for x in tables), len(cuts)

    root = Path(warehouse.root)
    load_run.run(warehouse, *WEEK, run_id="a")
    load_run.run(warehouse, *WEEK, run_id="b")
    before = folders()
    load_run.run(warehouse, *WEEK, run_id="c")
    assert folders() == before and max(before[0].values()) <= 2


def test_overwrite_of_a_partitioned_table(warehouse):
    rows, schema = warehouse.read("fact_usage_events").collect(), warehouse.read("fact_usage_events").schema
    few = warehouse.spark.createDataFrame(rows[:5], schema)
    warehouse.overwrite(few, "fact_usage_events")
    assert sorted(map(tuple, warehouse.read("fact_usage_events").collect())) == sorted(map(tuple, rows[:5]))
    warehouse.overwrite(warehouse.spark.createDataFrame(rows, schema), "fact_usage_events")
    assert warehouse.count("fact_usage_events") == len(rows)


def test_a_replacement_has_no_gap(warehouse, monkeypatch):
    """A reader that polls always finds one version or the other; a failure before the commit leaves the old contents."""
    kept = warehouse.read("fact_usage_events")
    rows, schema = kept.collect(), kept.schema
    few = warehouse.spark.createDataFrame(rows[:5], schema)
    table, seen, stop = warehouse.snapshots("fact_usage_events"), [], threading.Event()

    def poll():
        while not stop.is_set():
            commit = table.current()
            seen.append((commit.number, sum(map(len, commit.folders.values()))))

    reader = threading.Thread(target=poll)
    reader.start()
    for contents in (few, warehouse.spark.createDataFrame(rows, schema)):
        warehouse.overwrite(contents, "fact_usage_events")
    stop.set()
    reader.join()
    assert len(seen) > 3 and all(folders for _, folders in seen) and seen == sorted(seen, key=lambda x: x[0])

    def broken(self, commit):
        raise RuntimeError("injected")

    before, folders = table.current(), sorted(Path(table.data).glob("day=*/v=*"))
    monkeypatch.setattr(SnapshotTable, "_publish", broken)
    for change in (lambda: warehouse.overwrite(few, "fact_usage_events"), lambda: warehouse.append(few, "fact_usage_events")):
        with pytest.raises(RuntimeError, match="injected"):
            change()
    monkeypatch.undo()
    assert table.current() == before and sorted(Path(table.data).glob("day=*/v=*")) == folders
    assert warehouse.count("fact_usage_events") == len(rows)


def test_of_two_writers_one_commits(warehouse):
    table = warehouse.snapshots("fact_usage_events")
    now = table.current()
    table._publish(now)
    with pytest.raises(CommitConflict):
        table._publish(now)
    assert table.current().folders == now.folders


def test_extract_reads_the_days_of_its_window_only(warehouse):
    window = load_run.extract(warehouse, *WEEK)
    days = {x.rsplit("day=", 1)[1][:8] for x in window.inputFiles()}
    assert days and all("20240108" <= x <= "20240114" for x in days)
    everything = load_run.in_window(warehouse.read("cdr"), *WEEK)
    plan = everything._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(event_datetime), GreaterThanOrEqual(event_datetime" in plan
    assert everything.count() == window.count() > 0


def test_other_file_layouts_keep_the_same_copies(warehouse):
    """Copies with other contents under one id, in two orders and file sizes, and exact copies."""
    kept = warehouse.read("cdr")
    rows, schema = kept.collect(), kept.schema
    day = [x for x in rows if x.day and 20240108 <= x.day <= 20240114]
    other = [Row(**(x.asDict() | {"cost": (x.cost or 0) + 1, "contract_id": 7})) for x in day[:40]]
    found = []
    for seed, parts in ((1, 1), (2, 7)):
        mixed = day + other + day[:20] * 5
        random.Random(seed).shuffle(mixed)
        warehouse.overwrite(warehouse.spark.createDataFrame(mixed, schema).repartition(parts), "cdr")
        load_run.run(warehouse, *WEEK, run_id=f"layout {seed}")
        staged = warehouse.read("stg_cdr").drop("src_seq")
        found.append((facts(warehouse), sorted(map(repr, staged.collect()))))
        assert staged.where("etl_status = 'VALID'").groupBy("cdr_id").count().where("count > 1").isEmpty()
    assert found[0] == found[1]
    warehouse.overwrite(warehouse.spark.createDataFrame(rows, schema), "cdr")


def test_writes_and_keys_of_a_load(warehouse, monkeypatch):
    """One write of staging; the fact is written twice, numbered and final; keys follow on without a gap, whatever is retried."""
    written = []
    monkeypatch.setattr(SnapshotTable, "_publish", lambda self, commit, old=SnapshotTable._publish: (written.append(Path(self.folder).name), old(self, commit)))
    cut = load_run.stamp_sorted
    monkeypatch.setattr(load_run, "stamp_sorted", lambda df, order: (written.append("numbered"), cut(df, order))[1])
    last = warehouse.last_key("fact_usage_events")
    audit = load_run.run(warehouse, *WEEK, run_id="counted")
    assert written == ["stg_cdr", "numbered", "fact_usage_events"]
    keys = sorted(x[0] for x in warehouse.read_days("fact_usage_events", 20240108, 20240114).select("usage_event_key").collect())
    assert keys == list(range(last + 1, last + 1 + audit["fact_rows"])) and warehouse.last_key("fact_usage_events") == keys[-1]


def test_a_stopped_run_goes_on(warehouse, monkeypatch):
    whole = load_run.run(warehouse, *WEEK, run_id="whole")
    lines = warehouse.count("etl_audit")

    def stop(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(load_run, "load_fact", stop)
        with pytest.raises(RuntimeError, match="killed"):
            load_run.run(warehouse, *WEEK, run_id="resumed")
    with monkeypatch.context() as patch:
        patch.setattr(load_run, "run_suite", stop)  # the audit line is written by then
        patch.setattr(load_run, "load_staging", stop)
        patch.setattr(load_run, "load_dimensions", stop)
        with pytest.raises(RuntimeError, match="killed"):
            load_run.run(warehouse, *WEEK, run_id="resumed")
        assert warehouse.count("etl_audit") == lines + 1
        patch.undo()
        for name in ("load_staging", "load_dimensions", "load_fact"):
            patch.setattr(load_run, name, stop)
        resumed = load_run.run(warehouse, *WEEK, run_id="resumed")
    assert warehouse.count("etl_audit") == lines + 1
    assert resumed | {"run_id": ""} == whole | {"run_id": ""}
    # A run whose staging another load has replaced begins again.
    with monkeypatch.context() as patch:
        patch.setattr(load_run, "load_fact", stop)
        with pytest.raises(RuntimeError, match="killed"):
            load_run.run(warehouse, *WEEK, run_id="overtaken")
    load_run.run(warehouse, date(2024, 1, 15), date(2024, 1, 16), run_id="between")
    again = load_run.run(warehouse, *WEEK, run_id="overtaken")
    assert again["extracted"] == whole["extracted"] and again["fact_rows"] == whole["fact_rows"]


def test_days_that_lost_their_rows_are_dropped(warehouse):
    load_run.run(warehouse, *WEEK, run_id="full")
    whole = facts(warehouse)
    cdr = warehouse.read("cdr").where("to_date(event_datetime) <> date '2024-01-10' or event_datetime is null")
    kept = warehouse.read("cdr").collect(), warehouse.read("cdr").schema
    warehouse.overwrite(cdr, "cdr")
    load_run.run(warehouse, *WEEK, run_id="thinner")
    assert warehouse.read("fact_usage_events").where("day = 20240110").isEmpty()
    assert 0 < len(facts(warehouse)) < len(whole)
    warehouse.overwrite(warehouse.spark.createDataFrame(*kept), "cdr")
    load_run.run(warehouse, *WEEK, run_id="restored")
    assert facts(warehouse) == whole


def test_empty_window_empties_staging(warehouse):
    audit = load_run.run(warehouse, date(2030, 1, 1), date(2030, 1, 2), run_id="none")
    assert audit["extracted"] == 0 and warehouse.count("stg_cdr") == 0


def test_rejects_rows_outside_the_window(warehouse):
    fact = warehouse.read("fact_usage_events").limit(1).withColumn("day", F.lit(20200101))
    with pytest.raises(ValueError, match="outside"):
        warehouse.replace_days(fact, "fact_usage_events", 20240101, 20240131)


def test_a_load_of_another_year_extends_the_calendar(warehouse):
    before = warehouse.read("dim_time").count()
    usage = warehouse.read("cdr").where("event_datetime is not null")
    moved = usage.withColumn("event_datetime", F.expr("event_datetime + interval 1 year")).withColumn("cdr_id", F.expr("cdr_id + 1000000"))
    warehouse.append(moved, "cdr")
    audit = load_run.run(warehouse, date(2025, 1, 8), date(2025, 1, 14), run_id="w1")  # a run id that was used before
    assert audit["first_day"] == date(2025, 1, 8) and audit["fact_rows"] > 0
    assert set(audit["orphans"].values()) == {0}
    assert warehouse.read("dim_time").count() == before + 1460
    easter_monday = warehouse.read("dim_time").where("date_val = date '2025-04-21' and holiday_flag").count()
    assert easter_monday == 4
    tables = load_run.WarehouseTables(warehouse)
    calls = marts.calls_by_daypart(tables).agg(F.sum("total_calls")).collect()[0][0]
    assert calls == warehouse.read("fact_usage_events").agg(F.sum("call_count")).collect()[0][0]
    with pytest.raises(ValueError, match="2031"):
        load_run.extend_calendar(warehouse, date(2031, 1, 1), date(2031, 1, 2), lambda year: ())


def test_several_current_versions_stop_the_load(warehouse):
    kept = warehouse.read("dim_customer").collect(), warehouse.read("dim_customer").schema
    twice = warehouse.read("dim_customer").where("customer_id = 5")
    warehouse.append(twice, "dim_customer")
    with pytest.raises(ValueError, match="customer 5"):
        load_run.load_dimensions(warehouse, load_run.sources_of(warehouse), date(2024, 2, 1), WEEK)
    warehouse.overwrite(warehouse.spark.createDataFrame(*kept), "dim_customer")


def test_constraints_of_columns_with_defaults(warehouse):
    """The stored tables carry the columns that inserts may leave out; a null in them is reported."""
    tables = dict(load_run.WarehouseTables(warehouse))
    wanted = {name: rule for name, rule in checks.CONSTRAINTS.items() if name in checks.REQUIRED_DEFAULTS}
    lines = {(x.table_name, x.constraint_name): x.violations for x in checks.constraint_suite(tables, wanted).collect()}
    assert [lines[t, f"not null {c}"] for t, c in (("tariff", "valid_from"), ("customer", "created_at"), ("cdr", "created_at"))] == [0, 0, 0]
    tables["tariff"] = tables["tariff"].withColumn("valid_from", F.expr("nullif(valid_from, date '2024-01-01')"))
    lines = {x.constraint_name: x.violations for x in checks.constraint_suite(tables, {"tariff": wanted["tariff"]}).collect()}
    assert lines["not null valid_from"] == warehouse.count("tariff") > 0


def test_defaults_append_replace_and_counts(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), "u_", buckets=4)
    house.create_all()
    assert house.exists("region") and not house.exists("cdr_old") and house.count("cdr_old") == 0
    house.append(spark.createDataFrame([("Tyrol", 1)], "bundesland string, region_id int"), "region")
    assert house.read("region").collect()[0].asDict() == {"region_id": 1, "bundesland": "Tyrol", "country": "Austria"}
    assert house.replace(house.read("region").where("false"), "region") is False and house.count("region") == 1
    more = house.read("region").unionByName(house.read("region").withColumn("region_id", F.lit(2)))
    assert house.replace(more, "region") and house.count("region") == 2  # reads what it replaces
    house.append(spark.createDataFrame([(1, 2, 3)], "contract_id int, customer_id int, tariff_id int"), "contract")
    assert house.read("contract").collect()[0].status == "Active"
    house.append(spark.createDataFrame([(1,)], "cdr_id bigint"), "cdr")
    row = house.read("cdr").collect()[0]
    assert (row.duration_sec, row.fraud_flag) == (0, False) and row.created_at is not None
    assert house.count("region") == 2 and query(spark, "select count(*) as n from {r} where region_id > :low", {"low": 1}, r=house.read("region")).collect()[0].n == 1
    house.drop("region")
    assert not house.exists("region")
    for layer in ("u_ops", "u_dwh"):
        spark.sql(f"drop schema if exists {layer} cascade")


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k int, v string")
    write_csv(df.coalesce(1), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).where("v = 'a,b'").count() == 1
    path = write_parquet_stamped(df, str(tmp_path), "events", datetime(2024, 1, 2, 3, 4, 5))
    assert path.endswith("events_20240102_030405.parquet") and read_parquet(spark, path).count() == 2
