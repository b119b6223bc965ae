"""Warehouse tables: typed parquet tables in the ``ops`` and ``dwh`` schemas of one catalog."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.sources.buckets import BucketTable
from tidewell.sources.schemas import BUCKETS, DAYS, KEYS, TABLES, columns_of
from tidewell.sources.snapshots import SnapshotTable

COMMITTED = {*DAYS, *BUCKETS}  # tables whose contents a commit file names


def query(spark: SparkSession, sql: str, params: dict[str, Any] | list[Any] | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL with bound parameters; ``{name}`` in the text stands for a frame passed by that name."""
    return spark.sql(sql, args=params, **frames) if params is not None else spark.sql(sql, **frames)


class Warehouse:
    """Creates, fills and inspects the tables below one root folder on shared storage.

    A table is a catalog entry over a versioned folder: replacing its contents writes a new folder and then
    points the entry at it, so a job may replace the table it reads and a failed job leaves the old version.
    The newest ``versions`` folders of a table are kept, for readers that began before a replacement.

    Tables in day partitions (:data:`DAYS`) are no catalog entries but :class:`SnapshotTable`; a new window, a replacement and the last
    surrogate key given out take effect with one commit file. Tables in hash buckets (:data:`BUCKETS`) are :class:`BucketTable`: the same, by
    bucket. ``buckets`` holds for tables that are created; where it is not below ``spark.sql.shuffle.partitions``, joins keep the buckets.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", versions: int = 2, buckets: int = 64):
        self.spark, self.root, self.prefix, self.versions = spark, root.rstrip("/"), prefix, max(1, versions)
        self.buckets = buckets

    def name(self, table: str) -> str:
        layer = "ops" if table in TABLES["ops"] else "dwh"
        return f"{self.prefix}{layer}.{table}"

    def _fresh_folder(self, table: str) -> str:
        return f"{self.root}/{self.name(table).replace('.', '/')}/v-{uuid.uuid4().hex}"

    def create_all(self) -> None:
        """Drop and create every table of both schemas, empty."""
        for layer, tables in TABLES.items():
            self.spark.sql(f"create schema if not exists {self.prefix}{layer}")
            for table in tables:
                self.drop(table)
                self.create(table)

    def snapshots(self, table: str) -> SnapshotTable:
        """The commits of a table in day partitions or hash buckets."""
        schema = StructType.fromDDL(", ".join(f"{name} {kind}" for name, (kind, _) in columns_of(table).items()))
        folder = f"{self.root}/{self.name(table).replace('.', '/')}"
        if key := BUCKETS.get(table):
            return BucketTable(self.spark, folder, schema, self.name(table), key, self.buckets, self.versions)
        return SnapshotTable(self.spark, folder, schema, self.versions)

    def create(self, table: str) -> None:
        if table in COMMITTED:
            self.snapshots(table).create()
        else:
            self._create_at(self.name(table), table, self._fresh_folder(table))

    def _create_at(self, name: str, table: str, folder: str) -> None:
        layer = "ops" if table in TABLES["ops"] else "dwh"
        self.spark.sql(f"create table {name} ({TABLES[layer][table]}) using parquet location '{folder}'")

    def _drop_old_versions(self, table: str) -> None:
        """Delete all but the newest folders of a table."""
        parent = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{self.name(table).replace('.', '/')}")
        system = parent.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = sorted(system.listStatus(parent), key=lambda x: (x.getModificationTime(), x.getPath().getName()))
        current = self.spark.sql(f"describe formatted {self.name(table)}").where("col_name = 'Location'").collect()[0]["data_type"]
        old = [x.getPath() for x in found if x.getPath().getName() != current.rstrip("/").rsplit("/", 1)[-1]]
        for path in old[: max(0, len(old) - self.versions + 1)]:
            system.delete(path, True)

    def drop(self, table: str) -> None:
        if table in COMMITTED:
            self.snapshots(table).drop()
        else:
            self.spark.sql(f"drop table if exists {self.name(table)}")

    def exists(self, table: str) -> bool:
        return self.snapshots(table).exists() if table in COMMITTED else self.spark.catalog.tableExists(self.name(table))

    def count(self, table: str) -> int:
        """Rows of a table, 0 if it is missing."""
        return self.read(table).count() if self.exists(table) else 0

    def read(self, table: str) -> DataFrame:
        return self.snapshots(table).read() if table in COMMITTED else self.spark.table(self.name(table))

    def read_clustered(self, table: str, slices: Iterable[int] | None = None) -> DataFrame:
        """A table in hash buckets, or some of its slices, so that joins and groups by its key do not shuffle it."""
        return self.snapshots(table).read_clustered(slices)

    def read_days(self, table: str, first: int, last: int) -> DataFrame:
        """The days ``first``..``last`` (yyyymmdd) of a table in day partitions; no other folder is listed."""
        return self.snapshots(table).read(first, last)

    def _complete(self, df: DataFrame, table: str, keep_day: bool = False) -> DataFrame:
        """All columns of a table in day partitions or buckets, with their types; those that ``df`` lacks take their defaults.

        The day follows from the other columns, unless the caller's is to be kept.
        """
        listed = columns_of(table)
        if unknown := set(df.columns) - set(listed):
            raise ValueError(f"{table} has no columns {', '.join(sorted(unknown))}")
        given = {name: F.expr(default or "null") for name, (_, default) in listed.items() if name not in df.columns and (name != "day" or table not in DAYS)}
        whole = df.withColumns(given) if given else df
        stays = table not in DAYS or (keep_day and "day" in df.columns)
        dated = whole if stays else whole.withColumn("day", F.expr(DAYS[table]))
        return dated.select(*[F.col(name).cast(kind).alias(name) for name, (kind, _) in listed.items()])

    def _by_part(self, df: DataFrame, table: str) -> DataFrame:
        """Complete rows, with one task for each day, split where a day is large, so that a day gets few files."""
        rows = self._complete(df, table)
        return rows.hint("rebalance", "day") if table in DAYS else rows

    def _marks(self, table: str, df: DataFrame) -> dict[str, int] | None:
        """The last key given out, if ``df`` brings keys of its own."""
        if (key := KEYS.get(table)) is None or key not in df.columns:
            return None
        most = df.agg(F.max(key).alias("most")).collect()[0]["most"]
        return {key: max(most or 0, self.snapshots(table).current().marks.get(key, 0))}

    def last_key(self, table: str) -> int:
        """The last surrogate key given out, 0 before the first."""
        return self.snapshots(table).current().marks.get(KEYS[table], 0)

    def append(self, df: DataFrame, table: str) -> None:
        """Insert by column name; columns that ``df`` lacks take the table's defaults."""
        if table in COMMITTED:
            self.snapshots(table).append(self._by_part(df, table), self._marks(table, df))
            return
        columns = ", ".join(df.columns)
        self.spark.sql(f"insert into {self.name(table)} ({columns}) select {columns} from {{rows}}", rows=df)

    def replace(self, df: DataFrame, table: str) -> bool:
        """Swap in new contents. An empty frame changes nothing and returns False."""
        if df.isEmpty():
            return False
        self.overwrite(df, table)
        return True

    def overwrite(self, df: DataFrame, table: str) -> None:
        """Swap in new contents, also empty ones. Missing columns take the table's defaults."""
        if table in COMMITTED:
            self.snapshots(table).overwrite(self._by_part(df, table), self._marks(table, df))
            return
        draft = f"{self.name(table)}_draft_{uuid.uuid4().hex[:8]}"
        folder = self._fresh_folder(table)
        self._create_at(draft, table, folder)
        try:
            columns = ", ".join(df.columns)
            self.spark.sql(f"insert into {draft} ({columns}) select {columns} from {{rows}}", rows=df)
        finally:
            self.spark.sql(f"drop table {draft}")  # an external table: its files stay
        self.spark.sql(f"alter table {self.name(table)} set location '{folder}'")
        self.spark.catalog.refreshTable(self.name(table))
        self._drop_old_versions(table)

    def replace_days(self, df: DataFrame, table: str, first: int, last: int, last_key: int | None = None) -> None:
        """Make ``df`` the contents of the days ``first``..``last`` (yyyymmdd) of a table in day partitions.

        Days of the range without rows become empty, so a repeated load of a window ends in the same state as the first. ``last_key`` is
        the last surrogate key among the rows; it is kept in the same commit.
        """
        marks = None if last_key is None else {KEYS[table]: last_key}
        self.snapshots(table).replace_days(self._complete(df, table, keep_day=True), first, last, marks)

    def replace_slices(self, df: DataFrame, table: str, slices: Iterable[int], last_key: int | None = None) -> None:
        """Make ``df`` the contents of some slices of a table in hash buckets; the files of all others stay as they are."""
        marks = None if last_key is None else {KEYS[table]: last_key}
        self.snapshots(table).replace_slices(self._complete(df, table), slices, marks)
