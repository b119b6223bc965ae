"""Tables in hash buckets: what a change rewrites, what a join shuffles, and the customer dimension kept in them."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.operators import dimensions
from tidewell.operators.rules import Reference, check_references
from tidewell.plans import checks, load_run
from tidewell.session import materialize
from tidewell.sources.buckets import BucketTable
from tidewell.sources.snapshots import CommitConflict
from tidewell.sources.tables import Warehouse

FIRST, SECOND, THIRD = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)


@pytest.fixture
def table(spark, tmp_path):
    spark.sql("create schema if not exists b_dwh")
    made = BucketTable(spark, str(tmp_path / "pairs"), StructType.fromDDL("k int, w string"), "b_dwh.pairs", "k", 8)
    made.create()
    yield made
    spark.sql("drop schema b_dwh cascade")


@pytest.fixture
def no_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_scans(df, column):
    """Scans of a table with ``column`` whose rows reach an exchange before any join or aggregate."""
    above, found = [], []
    for line in plan_of(df).splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        above = [x for x in above if x[0] < at]
        if "FileScan" in line and column in line:
            first = next((x for _, x in reversed(above) if any(y in x for y in ("Exchange", "Join", "Aggregate"))), "")
            found += [line] if "Exchange" in first else []
        above.append((at, line))
    return found


def files(table):
    return {x for x in Path(table.data).glob("slice=*/v=*/*.parquet")}


def test_both_ways_of_reading_agree(spark, table):
    assert table.read().isEmpty() and table.read_clustered().isEmpty() and table.read_clustered().columns == ["k", "w"]
    table.append(spark.range(500).selectExpr("cast(id as int) as k", "'a' as w"))
    table.append(spark.sql("select * from values (cast(null as int), 'none'), (7, 'again'), (7, 'again') as t(k, w)"))
    rows = sorted(map(repr, table.read().collect()))
    assert len(rows) == 503 and rows == sorted(map(repr, table.read_clustered().collect()))
    kept = table.read_clustered([3, 5])
    expected = table.read().where(table.slice_of().isin(3, 5))
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, expected.collect())) != []
    assert {x.split("slice=")[1][0] for x in kept.inputFiles()} == {"3", "5"}
    empty = table.read().where("false")
    table.append(empty)
    assert table.read().count() == 503
    for number in range(4):
        table.append(spark.createDataFrame([(7, str(number))], "k int, w string"))
    most = max(map(len, table.current().folders.values()))
    table.compact_slices(most=4)
    assert most > 4 >= max(map(len, table.current().folders.values())) and table.read_clustered().count() == 507


def test_a_change_rewrites_its_slices_only(spark, table):
    table.append(spark.range(500).selectExpr("cast(id as int) as k", "'a' as w"))
    before, old = table.current(), files(table)
    table.replace_slices(table.read_clustered([2]).withColumn("w", F.lit("b")), [2])
    after = table.current()
    assert {x for x in after.folders if after.folders[x] != before.folders[x]} == {"slice=2"}
    assert {x.parent.parent.name for x in files(table) - old} == {"slice=2"}
    assert {x.w for x in table.read_clustered([2]).collect()} == {"b"} and {x.w for x in table.read_clustered([1]).collect()} == {"a"}
    with pytest.raises(ValueError, match="slice"):
        table.replace_slices(table.read_clustered([1]), [2])
    assert table.current() == after
    table.replace_slices(table.read().where("false"), [2])
    assert "slice=2" not in table.current().folders and table.read_clustered([2]).isEmpty()
    # Only the folders and catalog tables of the last two commits remain, and a writer that comes late fails.
    named = {f"{x}/v={v}" for c in (after, table.current()) for x, versions in c.folders.items() for v in versions}
    assert {f"{x.parent.parent.name}/{x.parent.name}" for x in files(table)} == named
    assert len(spark.sql("show tables in b_dwh like 'pairs*'").collect()) <= 2
    with pytest.raises(CommitConflict):
        table._publish(after)


def test_the_catalog_is_made_again_from_the_commit(spark, table):
    table.append(spark.range(100).selectExpr("cast(id as int) as k", "'a' as w"))
    assert table.read_clustered().count() == 100
    name = table._table_of(table.current())
    spark.sql(f"drop table {name}")
    table._create(name, 8)  # as if a reader had stopped before it added the partitions
    assert spark.table(name).isEmpty() and table.read_clustered().count() == 100
    # Entries that another session's catalog kept do not stand for a table that was made anew.
    kept = table.current()
    table.create()
    table._create(name, 8)
    spark.sql(f"alter table {name} set tblproperties ('all_partitions_added' = 'true')")
    table.append(spark.range(30).selectExpr("cast(id as int) as k", "'b' as w"))
    assert table.current().number == kept.number and table.read_clustered().count() == 30
    table.append(spark.range(30, 100).selectExpr("cast(id as int) as k", "'b' as w"))
    other = BucketTable(spark, table.folder, table.schema, "b_dwh.pairs", "k", buckets=3)
    assert other.buckets == 8 and other.read_clustered().count() == 100


@pytest.mark.parametrize("partitions", ["4", "8"])
def test_joins_on_the_key_leave_the_table_where_it_is(spark, table, no_broadcast, partitions):
    table.append(spark.range(500).selectExpr("cast(id as int) as k", "'a' as w"))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    other = spark.range(400, 700).selectExpr("cast(id as int) as k")
    joined = other.join(table.read_clustered(), "k", "full_outer")
    assert "Bucketed: true" in plan_of(joined) and shuffled_scans(joined, "k#") == [] and joined.count() == 700
    plain = other.join(table.read(), "k", "full_outer")
    assert shuffled_scans(plain, "k#") and plain.count() == 700
    spark.conf.set("spark.sql.shuffle.partitions", kept)


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    made = Warehouse(spark, str(tmp_path_factory.mktemp("buckets")), "k_", buckets=16)
    made.create_all()
    made.append(dimensions.unknown_customer(spark), "dim_customer")
    yield made
    for layer in ("k_ops", "k_dwh"):
        spark.sql(f"drop schema {layer} cascade")


def people(spark, low, high, segment="'A'", profession="'p'"):
    fixed = {"age": "cast(30 as int)", "birth_date": "date '1990-01-01'", "segment": segment, "profession": profession}
    return spark.range(low, high).selectExpr("cast(id as int) as customer_id", *[f"{fixed.get(x, repr(x))} as {x}" for x in dimensions.CUSTOMER_ATTRIBUTES])


def test_customer_loads_follow_the_changes(spark, house, no_broadcast):
    assert load_run.load_customers(house, people(spark, 1, 301), FIRST)
    keys = sorted(x.customer_key for x in house.read("dim_customer").collect())
    assert keys == [-1, *range(1, 301)] and house.last_key("dim_customer") == 300
    table = house.snapshots("dim_customer")
    before, old = table.current(), house.read("dim_customer").collect()

    # The same delivery again, also with other untracked values, writes nothing.
    assert load_run.load_customers(house, people(spark, 1, 301).withColumn("city", F.lit("elsewhere")), SECOND) == []
    assert table.current() == before

    # Two changes and a new one: at most three slices are written, and the result is that of the whole comparison.
    delivery = people(spark, 1, 302, "case when id in (5, 9) then 'B' else 'A' end")
    expected = dimensions.apply_versions(spark.createDataFrame(old, house.read("dim_customer").schema), delivery, SECOND).collect()
    renewed = load_run.load_customers(house, delivery, SECOND)
    after = table.current()
    touched = {f"slice={x}" for x in renewed}
    assert 1 <= len(touched) <= 3 and {x for x in after.folders if after.folders[x] != before.folders.get(x)} == touched
    assert sorted(map(repr, house.read("dim_customer").collect())) == sorted(map(repr, expected))
    versions = house.read("dim_customer").where("customer_id = 5").orderBy("effective_from").collect()
    assert [(x.segment, x.is_current, x.effective_to) for x in versions] == [("A", False, date(2024, 1, 31)), ("B", True, None)]
    assert house.last_key("dim_customer") == 303

    # Null ids, repeated rows and missing customers.
    odd = people(spark, 9, 10, "'C'").unionByName(people(spark, 9, 10, "'C'")).unionByName(people(spark, 1, 2).withColumn("customer_id", F.lit(None).cast("int")))
    assert len(load_run.load_customers(house, odd, THIRD)) == 1
    assert house.read("dim_customer").where("customer_id = 9").count() == 3 and house.last_key("dim_customer") == 304
    assert load_run.load_customers(house, people(spark, 1, 2).where("false"), THIRD) == []

    existing = house.read_clustered("dim_customer")
    for frame in (dimensions.version_changes(existing, delivery), dimensions.ambiguous_entities(existing)):
        assert "Bucketed: true" in plan_of(frame) and shuffled_scans(frame, "customer_id#") == []


def test_changes_by_parts_are_the_whole_comparison(spark, sf_dir):
    from tidewell.plans.fixture_tables import SECOND_LOAD, FixtureTables

    tables = FixtureTables(spark, sf_dir)
    existing = materialize(tables["dim_customer_initial"], "existing")
    changes = materialize(dimensions.version_changes(existing, tables["customer_day2"]), "changes")
    last = existing.agg(F.max("customer_key")).collect()[0][0]
    slices = F.pmod(F.hash("customer_id"), F.lit(4))
    chosen = [x[0] for x in changes.select(slices).distinct().collect()]
    renewed = dimensions.apply_changes(existing.where(slices.isin(chosen)), changes, SECOND_LOAD, last)
    whole = renewed.unionByName(existing.where(~slices.isin(chosen)))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, tables["dim_customer"].collect()))


def test_references_to_parents_in_buckets(spark, house, no_broadcast):
    """The same counts as in one scan, without a shuffle of the parent."""
    house.append(spark.range(1, 101).selectExpr("cast(id as int) as contract_id", "1 as customer_id", "1 as tariff_id"), "contract")
    tables = load_run.WarehouseTables(house)
    usage = spark.sql("select cast(id % 130 as int) as contract_id from range(1, 1000)").unionByName(spark.sql("select cast(null as int) as contract_id from range(7)"))
    references = checks.REFERENCES["cdr"]
    stored = checks.parents_in_buckets(tables, references)
    assert list(stored) == [("contract", "contract_id")]
    for lost in (True, False):
        found = check_references(usage, references, {}, lost, stored)
        expected = check_references(usage, references, {"contract": tables["contract"]}, lost)
        assert found.collect() == expected.collect()
        assert "Bucketed: true" in plan_of(found) and shuffled_scans(found, "contract_id#") == []
    # A key beyond the parent's type has no parent; a child table with other parents keeps its shared scan for those.
    mixed = [*references, Reference("X-1", "wide", "event_key", "event_type", "event_key")]
    wide = spark.sql("select * from values (4294967297L, 1), (1L, 2), (null, 3) as t(contract_id, event_key)")
    kinds = spark.sql("select * from values (1), (2) as t(event_key)")
    rows = {x.rule_id: x.failed_rows for x in check_references(wide, mixed, {"event_type": kinds}, True, stored).collect()}
    assert rows == {"RI-09": 2, "X-1": 1}
    none = check_references(usage.where("false"), references, {}, True, stored).collect()
    assert [x.failed_rows for x in none] == [0]
