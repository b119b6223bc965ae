"""Window load of the warehouse: extract, stage, validate, dimensions, fact, audit, checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.calendar import calendar, holidays_of
from tidewell.operators import dimensions, rollup
from tidewell.operators.keys import number_stamped, stamp_sorted
from tidewell.operators.rules import summarize
from tidewell.operators.validate import stage, validate
from tidewell.plans import checks, marts
from tidewell.plans.ledger import RunLedger
from tidewell.session import discarding_cuts, materialize
from tidewell.sources.schemas import BUCKETS, TABLES
from tidewell.sources.tables import Warehouse


class WarehouseTables(Mapping):
    """The warehouse as the mapping that checks, marts and reports read."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse

    def __getitem__(self, name: str) -> DataFrame:
        return self.warehouse.read(name)

    def in_buckets(self, name: str, column: str) -> DataFrame | None:
        """A table as a bucketed scan, if it is kept in buckets of ``column``."""
        return self.warehouse.read_clustered(name) if BUCKETS.get(name) == column else None

    def __iter__(self) -> Iterator[str]:
        return iter([name for layer in TABLES.values() for name in layer])

    def __len__(self) -> int:
        return sum(len(layer) for layer in TABLES.values())


@dataclass(frozen=True)
class Sources:
    """Snapshots of the dimension sources for one run."""

    customers: DataFrame
    tariffs: DataFrame
    locations: DataFrame


def prepare(warehouse: Warehouse, event_types: DataFrame, channels: DataFrame) -> None:
    """Empty schemas with the unknown customer and the lookup dimensions."""
    warehouse.create_all()
    warehouse.append(event_types, "event_type")
    warehouse.append(channels, "channel")
    warehouse.append(dimensions.event_rows(event_types), "dim_event")
    warehouse.append(dimensions.channel_rows(channels), "dim_channel")
    warehouse.append(dimensions.unknown_customer(warehouse.spark), "dim_customer")


def sources_of(warehouse: Warehouse) -> Sources:
    return Sources(
        customers=warehouse.read("customer"),
        tariffs=dimensions.tariff_rows(warehouse.read("tariff"), warehouse.read("operator")),
        locations=dimensions.location_rows(warehouse.read("location")),
    )


def in_window(usage: DataFrame, start: date, end: date) -> DataFrame:
    """Usage whose event date lies in the window, as a range on the timestamp, so that a scan can skip row groups.

    Where there is a ``day`` column (yyyymmdd), whole partitions are left out as well.
    """
    moment = F.col("event_datetime")
    after_end = F.date_add(F.lit(end), 1).cast("timestamp_ntz")
    rows = usage.where((moment >= F.lit(start).cast("timestamp_ntz")) & (moment < after_end))
    return rows.where(F.col("day").between(*days_of(start, end))) if "day" in usage.columns else rows


def days_of(start: date, end: date) -> tuple[int, int]:
    return int(f"{start:%Y%m%d}"), int(f"{end:%Y%m%d}")


def extract(warehouse: Warehouse, start: date, end: date) -> DataFrame:
    """The usage of a window, with the place of each row in its file (``src_file``, ``src_seq``)."""
    usage = warehouse.read_days("cdr", *days_of(start, end))
    if usage.isEmpty():
        place = {"src_file": F.lit(None).cast("string"), "src_seq": F.lit(None).cast("bigint")}
    else:
        place = {"src_file": F.col("_metadata.file_path"), "src_seq": F.col("_metadata.row_index")}
    return in_window(usage.withColumns(place), start, end)


def load_staging(warehouse: Warehouse, batch: DataFrame, load_date: date) -> None:
    """Replace staging by the validated ``batch``, in one write. An empty batch empties it.

    Of the rows of one ``cdr_id`` the first by event time, then by all other columns, is kept, so another file layout keeps
    a row with the same contents. Rows that are equal in all of them are told apart by ``src_file`` and ``src_seq``, their place in the source; a
    batch without such places is written once to give it some.
    """
    if "src_seq" not in batch.columns:
        batch = materialize(batch, "batch").withColumns({"src_file": F.col("_metadata.file_path"), "src_seq": F.col("_metadata.row_index")})
    place = [x for x in ("src_file", "src_seq") if x in batch.columns]
    others = sorted(x for x in batch.columns if x not in ("event_datetime", "cdr_id", *place))
    marked = validate(stage(batch, load_date), sequence=["event_datetime", *others, *place])
    warehouse.overwrite(marked.drop("src_file"), "stg_cdr")


def extend_calendar(
    warehouse: Warehouse, first: date, last: date, holidays: Callable[[int], Iterable[date]] = holidays_of
) -> list[int]:
    """Add the whole years of ``first``..``last`` that ``dim_time`` lacks; rows that exist stay. Returns the years added."""
    there = {row[0] for row in warehouse.read("dim_time").select("year").distinct().collect()}
    missing = [year for year in range(first.year, last.year + 1) if year not in there]
    for year in missing:
        named = tuple(holidays(year))
        if not named:
            raise ValueError(f"no holidays are given for {year}")
        warehouse.append(calendar(warehouse.spark, date(year, 1, 1), date(year, 12, 31), named), "dim_time")
    return missing


def load_dimensions(
    warehouse: Warehouse,
    sources: Sources,
    load_date: date,
    window: tuple[date, date],
    holidays: Callable[[int], Iterable[date]] = holidays_of,
) -> None:
    extend_calendar(warehouse, *window, holidays)
    load_customers(warehouse, sources.customers, load_date)
    for table, source, key in (
        ("dim_tariff", sources.tariffs, "tariff_key"),
        ("dim_location", sources.locations, "location_key"),
    ):
        warehouse.overwrite(dimensions.overwrite_by_key(warehouse.read(table), source, key), table)


def load_customers(warehouse: Warehouse, delivered: DataFrame, load_date: date) -> list[int]:
    """Bring the customer dimension up to date; returns the slices that were rewritten, which are those with new or changed customers.

    The comparison reads the dimension by its buckets and shuffles the delivery only. What changed is written once; a delivery without
    changes leaves the table as it is.
    """
    existing = warehouse.read_clustered("dim_customer")
    broken = dimensions.ambiguous_entities(existing).limit(1).collect()
    if broken:
        raise ValueError(f"customer {broken[0].customer_id} has several current versions")
    newest = "created_at" if "created_at" in delivered.columns else None
    chosen = delivered.where("customer_id is not null").select("customer_id", *dimensions.CUSTOMER_ATTRIBUTES, *([newest] if newest else []))
    customers = dimensions.one_per_entity(chosen, newest_by=newest)
    changes = materialize(dimensions.version_changes(existing, customers), "changes")
    # At most one row for each slice of the table.
    sizes = changes.groupBy(warehouse.snapshots("dim_customer").slice_of().alias("slice")).count().collect()
    slices = sorted(x["slice"] for x in sizes)
    if slices:
        last = warehouse.last_key("dim_customer")
        part = warehouse.read_clustered("dim_customer", slices)
        renewed = dimensions.apply_changes(part, changes, load_date, last)
        warehouse.replace_slices(renewed, "dim_customer", slices, last + sum(x["count"] for x in sizes))
    return slices


def load_fact(warehouse: Warehouse, start: date, end: date) -> None:
    """Roll up the valid staged rows and make them the contents of the window's days.

    The rows are sorted by day and written once with their place; the second write adds their keys, which follow the last one given out, and
    takes effect together with the new last key.
    """
    valid = warehouse.read("stg_cdr").where("etl_status = 'VALID'")
    rolled = rollup.usage_rollup(valid)
    resolved = rollup.resolve_keys(rolled, warehouse.read("contract"), warehouse.read("dim_customer"))
    dated = resolved.withColumn("day", F.floor(F.col("time_key") / 100).cast("int"))
    placed = stamp_sorted(dated, ["day", "contract_id", "time_key", "event_key", "location_key"])
    last = warehouse.last_key("fact_usage_events")
    fact = number_stamped(placed, "usage_event_key", last).drop("contract_id")
    warehouse.replace_days(fact, "fact_usage_events", *days_of(start, end), last_key=last + placed.count())


def run(
    warehouse: Warehouse,
    start: date,
    end: date,
    run_id: str,
    sources: Sources | None = None,
    load_date: date | None = None,
    bounds: checks.Bounds | None = None,
    holidays: Callable[[int], Iterable[date]] = holidays_of,
) -> dict:
    """Load one window and check what was loaded.

    Returns the audit line of this run, ``orphans`` (by foreign key of the fact) and ``suite`` (summary of the checks, within ``bounds``
    or else within the window). Repeating a window leaves the fact contents unchanged except for its surrogate keys, which go on counting.
    A run that was stopped is started again with the same id and window and goes on after its last finished step.
    """
    load_date = load_date or end
    with discarding_cuts(warehouse.spark):  # all that remains is in tables or collected
        return _load(warehouse, start, end, run_id, sources or sources_of(warehouse), load_date, bounds, holidays)


def _load(
    warehouse: Warehouse,
    start: date,
    end: date,
    run_id: str,
    sources: Sources,
    load_date: date,
    bounds: checks.Bounds | None,
    holidays: Callable[[int], Iterable[date]],
) -> dict:
    ledger = RunLedger(warehouse, run_id, start, end)
    ledger.step("staging", lambda: load_staging(warehouse, extract(warehouse, start, end), load_date), "stg_cdr")
    ledger.step("dimensions", lambda: load_dimensions(warehouse, sources, load_date, (start, end), holidays))
    ledger.step("fact", lambda: load_fact(warehouse, start, end), "fact_usage_events")
    loaded = warehouse.read_days("fact_usage_events", *days_of(start, end))
    line = rollup.load_audit(warehouse.read("stg_cdr"), loaded, run_id)
    line = line.withColumn("first_day", F.lit(start)).withColumn("last_day", F.lit(end))
    audit = line.collect()[0]
    lines = warehouse.read("etl_audit")
    before = ledger.step("before audit", lambda: {"lines": lines.count()})["lines"]
    if lines.count() == before:  # else the line was written before the run stopped
        warehouse.append(warehouse.spark.createDataFrame([audit], line.schema), "etl_audit")
    _, suite = run_suite(warehouse, bounds or checks.Bounds(load_date, start, end))
    found = audit.asDict() | {"orphans": verify(warehouse), "suite": suite}
    ledger.finish()
    return found


def verify(warehouse: Warehouse) -> dict[str, int]:
    """Orphan counts of the fact, or nothing if it is empty."""
    if warehouse.read("fact_usage_events").isEmpty():
        return {}
    return {row.check_name: row.n for row in marts.orphan_summary(WarehouseTables(warehouse)).collect()}


def run_suite(warehouse: Warehouse, bounds: checks.Bounds) -> tuple[DataFrame, dict]:
    """All checks of the loaded warehouse, written once, and their summary."""
    results = materialize(checks.runner_suite(WarehouseTables(warehouse), bounds), "checks")
    return results, summarize(results).collect()[0].asDict()
