"""Which steps of a load are done, so that a run that was stopped goes on where it was."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import date

from tidewell.sources.storage import Storage
from tidewell.sources.tables import Warehouse


class RunLedger:
    """A small file for each unfinished run (run id and window), below the warehouse's root.

    A step is noted after its tables were committed, together with the commit numbers of those in day partitions. When the run is
    started again, noted steps are left out, unless another load has changed one of those tables since: then the run begins again.
    A step that committed but could not be noted is repeated; every step gives the same contents when repeated.
    """

    def __init__(self, warehouse: Warehouse, run_id: str, start: date, end: date):
        named = hashlib.sha256(json.dumps([run_id, str(start), str(end)]).encode()).hexdigest()
        self.warehouse, self.storage = warehouse, Storage(warehouse.spark)
        self.path = f"{warehouse.root}/{warehouse.prefix}runs/{named}.json"
        self.steps: dict[str, dict] = json.loads(self.storage.read(self.path)) if self.storage.exists(self.path) else {}
        if any(self._commit(table) != number for step in self.steps.values() for table, number in step["commits"].items()):
            self.steps = {}

    def _commit(self, table: str) -> int:
        return self.warehouse.snapshots(table).current().number

    def step(self, name: str, work: Callable[[], dict | None], *tables: str) -> dict:
        """Do ``work`` unless it is noted; returns what it returned (JSON values). ``tables`` in day partitions are its result."""
        if name not in self.steps:
            found = work() or {}
            self.steps[name] = {"commits": {x: self._commit(x) for x in tables}, "found": found}
            self.storage.replace(self.path, json.dumps(self.steps))
        return self.steps[name]["found"]

    def finish(self) -> None:
        self.storage.delete(self.path)
