"""Tables in hash buckets of one key: joins and aggregates on it need no shuffle of the table, and a change rewrites its buckets only.

Commits and layout are those of :class:`SnapshotTable`, with a slice for each hash bucket in place of a day::

    data/slice=5/v=<version>/part-..._00005...parquet

A commit that is read by its buckets gets a catalog table of Spark's own bucketed kind, with one partition for each folder that the commit names.
It can be made again from the commit at any time, so the catalog holds nothing that could be lost. A plain :meth:`read` does without it and
leaves adaptive execution free to split hot keys of a join.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.sources.snapshots import VERSION, Commit, SnapshotTable

SLICE = "slice"
_COUNT = "buckets"  # the mark that keeps the number of buckets
_WHOLE = "all_partitions_added"


class BucketTable(SnapshotTable):
    """One table in ``buckets`` hash buckets of ``key``; the number is fixed when the table is created."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, name: str, key: str, buckets: int, versions: int = 2):
        super().__init__(spark, folder, schema, versions)
        self.name, self.key, self._wanted = name, key, buckets

    @property
    def buckets(self) -> int:
        return self.current().marks[_COUNT]

    def slice_of(self) -> Column:
        """The bucket of a row's key, as Spark's bucketed writer counts it; the key column must have the table's type."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets))

    # reading

    def read_clustered(self, slices: Iterable[int] | None = None) -> DataFrame:
        """The current contents, or those of some slices, as a bucketed scan: joins and groups by the key do not shuffle it."""
        commit = self.current()
        if not commit.folders:
            return self.spark.createDataFrame([], self.schema)
        table = self.spark.table(self._registered(commit))
        if slices is not None:
            table = table.where(F.col(SLICE).isin(sorted(slices)))  # other folders are not looked at
        return table.select(*self.schema.names)

    def _create(self, name: str, buckets: int) -> None:
        columns = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in self.schema.fields)
        self.spark.sql(
            f"create table if not exists {name} ({columns}, {SLICE} int, {VERSION} string) using parquet "
            f"partitioned by ({SLICE}, {VERSION}) clustered by ({self.key}) into {buckets} buckets location '{self.data}'"
        )

    def _registered(self, commit: Commit) -> str:
        """The catalog table of a commit. Each step may be repeated, so one that was left half made is completed."""
        name = self._table_of(commit)
        if self.spark.catalog.tableExists(name):
            marked = self.spark.sql(f"show tblproperties {name}").where(F.col("key") == _WHOLE)
            if not marked.isEmpty():
                return name
        self._create(name, commit.marks[_COUNT])
        parts = [f"partition ({folder.replace('=', ' = ')}, {VERSION} = '{x}')" for folder, versions in sorted(commit.folders.items()) for x in versions]
        self.spark.sql(f"alter table {name} add if not exists {' '.join(parts)}")
        self.spark.sql(f"alter table {name} set tblproperties ('{_WHOLE}' = 'true')")
        return name

    def _table_of(self, commit: Commit) -> str:
        """Number and contents make the name, so an entry that another session's catalog kept can never stand for a later table's commit."""
        named = hashlib.sha256(json.dumps([self.data, commit.folders], sort_keys=True).encode()).hexdigest()[:12]
        return f"{self.name}_c{commit.number:06d}_{named}"

    def _forget(self, before: int | None = None) -> None:
        """Drop the catalog tables of all commits, or of those before a number."""
        schema, _, table = self.name.rpartition(".")
        if not self.spark.catalog.databaseExists(schema):
            return
        for row in self.spark.sql(f"show tables in {schema} like '{table}_c*'").collect():
            found = re.fullmatch(rf"{re.escape(table)}_c(\d+)_[0-9a-f]{{12}}", row.tableName)
            if found and (before is None or int(found[1]) < before):
                self.spark.sql(f"drop table if exists {schema}.{row.tableName}")

    # writing

    def create(self) -> None:
        self.drop()
        self._publish(Commit(marks={_COUNT: self._wanted}))

    def drop(self) -> None:
        self._forget()
        super().drop()

    def replace_slices(self, df: DataFrame, slices: Iterable[int], marks: dict[str, int] | None = None) -> Commit:
        """Make ``df`` the contents of the given slices; all others keep their files."""
        chosen = {f"{SLICE}={x}" for x in slices}

        def swap(now: Commit, new: dict[str, str]) -> dict[str, list[str]]:
            if outside := sorted(set(new) - chosen):
                raise ValueError(f"rows outside the slices: {', '.join(outside)}")
            return {x: versions for x, versions in now.folders.items() if x not in chosen} | {x: [version] for x, version in new.items()}

        return self._change(df, swap, marks)

    def compact_slices(self, most: int = 4) -> Commit:
        """Rewrite the slices that more than ``most`` appends make up."""
        crowded = [int(x.removeprefix(f"{SLICE}=")) for x, versions in self.current().folders.items() if len(versions) > most]
        return self.replace_slices(self.read_clustered(crowded), crowded) if crowded else self.current()

    def _write(self, rows: DataFrame) -> None:
        count, draft = self.buckets, f"{self.name}_draft_{uuid.uuid4().hex[:8]}"
        self._create(draft, count)
        try:
            placed = rows.withColumn(SLICE, self.slice_of()).repartition(count, self.key)
            placed.select(*self.schema.names, SLICE, VERSION).write.insertInto(draft)
        finally:
            self.spark.sql(f"drop table {draft}")  # an external table: its files stay

    def _clean(self) -> None:
        super()._clean()
        self._forget(min(self._numbers()))
