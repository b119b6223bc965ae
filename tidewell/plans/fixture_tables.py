"""The operational and warehouse tables, derived from the generated test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tidewell.functions.calendar import calendar_covering
from tidewell.operators import dimensions, rollup
from tidewell.operators.validate import stage, validate
from tidewell.plans.checks import Bounds
from tidewell.session import materialize
from tidewell.sources.files import read_parquet
from tidewell.sources.telecom import VIEWS

FIRST_LOAD = date(2024, 1, 1)
SECOND_LOAD = date(2024, 1, 16)
STAGE_DATE = date(2024, 1, 31)
WINDOW = (date(2024, 1, 8), date(2024, 1, 21))
HORIZON = date(2024, 12, 31)
BOUNDS = Bounds(as_of=date(2024, 1, 28), first_day=date(2024, 1, 1), last_day=date(2024, 1, 28))


class FixtureTables(Mapping):
    """Lazily builds each table on first use; ``keep`` writes chosen ones so several plans can share them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._built: dict[str, DataFrame] = {}
        self._read = cache(lambda path: read_parquet(spark, path))  # one look at the footers per set of tables
        self._derived: dict[str, Callable[[], DataFrame]] = {
            "stg_pending": lambda: stage(self["cdr"], STAGE_DATE),
            "stg_cdr": lambda: validate(self["stg_pending"]),
            "valid_cdr": lambda: self["stg_cdr"].where("etl_status = 'VALID'"),
            "dim_time": lambda: calendar_covering(self["cdr"], "event_datetime"),
            "dim_tariff": lambda: dimensions.tariff_rows(self["tariff"], self["operator"]),
            "dim_location": lambda: dimensions.location_rows(self["location"]),
            "dim_event": lambda: dimensions.event_rows(self["event_type"]),
            "dim_channel": lambda: dimensions.channel_rows(self["channel"]),
            "dim_customer_initial": lambda: dimensions.first_versions(
                dimensions.unknown_customer(spark), self["customer_day1"], FIRST_LOAD
            ),
            "dim_customer": lambda: dimensions.apply_versions(
                self["dim_customer_initial"], self["customer_day2"], SECOND_LOAD
            ),
            "usage_rollup": lambda: rollup.usage_rollup(self["valid_cdr"]),
            "fact_usage_events": lambda: rollup.resolve_keys(self["usage_rollup"], self["contract"], self["dim_customer"]),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in self._derived:
                self._built[name] = self._derived[name]()
            else:
                self._built[name] = VIEWS[f"v_{name}"].frame(self._read, self.folder)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter([*self._derived, *(name.removeprefix("v_") for name in VIEWS)])

    def __len__(self) -> int:
        return len(self._derived) + len(VIEWS)

    def keep(self, *names: str) -> "FixtureTables":
        for name in names:
            self._built[name] = materialize(self[name], name)
        return self

    def swap(self, **frames: DataFrame) -> "FixtureTables":
        self._built.update(frames)
        return self
