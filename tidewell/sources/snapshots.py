"""Tables in day partitions whose current contents are named by one small commit file.

Layout below the table's folder::

    data/day=20240108/v=<version>/part-...parquet     written once, never changed
    commits/000000000007.json                         the folders of the current contents, and counters

A writer first writes its rows under a version of its own and then adds the next commit file by a rename. Until that file is there, readers
see the previous contents; from then on they see the new ones. There is no moment without a table, a failure before the rename leaves
the old contents, and rows and counters change together. Two writers of one table cannot both make the same commit: the second fails.
Readers list only the folders that a commit names, and only those of the days they ask for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewell.sources.storage import Storage

DAY = "day"
VERSION = "v"


class CommitConflict(RuntimeError):
    """Another writer has changed the table meanwhile; its contents are as that writer left them."""


@dataclass(frozen=True)
class Commit:
    """Versions by day folder (``day=...``), and counters such as the last key given out."""

    number: int = -1
    folders: dict[str, list[str]] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)


def day_of(folder: str) -> int | None:
    """The day of a partition folder, None for rows without one."""
    value = folder.removeprefix(f"{DAY}=")
    return int(value) if value.lstrip("-").isdigit() else None


class SnapshotTable:
    """One table of rows with a ``day`` column (yyyymmdd, may be null)."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, versions: int = 2):
        self.spark, self.schema, self.versions = spark, schema, max(1, versions)
        self.folder, self.data, self.commits = folder, f"{folder}/data", f"{folder}/commits"
        self.storage = Storage(spark)

    # reading

    def _numbers(self) -> list[int]:
        return sorted(int(x.removesuffix(".json")) for x in self.storage.names(self.commits) if x.endswith(".json") and not x.startswith((".", "_")))

    def _load(self, number: int) -> Commit:
        return Commit(number, **json.loads(self.storage.read(self._commit_file(number))))

    def _commit_file(self, number: int) -> str:
        return f"{self.commits}/{number:012d}.json"

    def exists(self) -> bool:
        return bool(self._numbers())

    def current(self) -> Commit:
        """The newest commit. A file may be cleaned up between listing and reading; then there is a newer one."""
        for _ in range(10):
            if not (numbers := self._numbers()):
                raise ValueError(f"no table at {self.folder}")
            try:
                return self._load(numbers[-1])
            except FileNotFoundError:
                continue
        raise RuntimeError(f"commits of {self.folder} change faster than they can be read")

    def read(self, first: int | None = None, last: int | None = None, commit: Commit | None = None) -> DataFrame:
        """The current contents, or those of the days ``first``..``last`` (rows without a day are then left out)."""
        commit = commit or self.current()
        bounded = first is not None or last is not None
        chosen = [
            f"{self.data}/{folder}/{VERSION}={version}"
            for folder, versions in sorted(commit.folders.items())
            if not bounded or ((day := day_of(folder)) is not None and (first is None or day >= first) and (last is None or day <= last))
            for version in versions
        ]
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        stored = StructType([*self.schema.fields, StructField(VERSION, StringType())])
        return self.spark.read.schema(stored).option("basePath", self.data).parquet(*chosen).select(*self.schema.names)

    # writing

    def create(self) -> None:
        """Drop what is there and begin with an empty table."""
        self.drop()
        self._publish(Commit())

    def drop(self) -> None:
        self.storage.delete(self.folder)

    def append(self, df: DataFrame, marks: dict[str, int] | None = None) -> Commit:
        def add(now: Commit, new: dict[str, str]) -> dict[str, list[str]]:
            return {x: now.folders.get(x, []) + ([new[x]] if x in new else []) for x in {*now.folders, *new}}

        return self._change(df, add, marks)

    def overwrite(self, df: DataFrame, marks: dict[str, int] | None = None) -> Commit:
        return self._change(df, lambda now, new: {x: [version] for x, version in new.items()}, marks)

    def replace_days(self, df: DataFrame, first: int, last: int, marks: dict[str, int] | None = None) -> Commit:
        """Make ``df`` the contents of the days ``first``..``last``; days of the range that it lacks become empty, all others stay."""
        inside = lambda folder: (day := day_of(folder)) is not None and first <= day <= last

        def swap(now: Commit, new: dict[str, str]) -> dict[str, list[str]]:
            if outside := sorted(x for x in new if not inside(x)):
                raise ValueError(f"rows outside {first}..{last}: {', '.join(outside)}")
            return {x: versions for x, versions in now.folders.items() if not inside(x)} | {x: [version] for x, version in new.items()}

        return self._change(df, swap, marks)

    def compact(self, first: int, last: int) -> Commit:
        """Rewrite the days ``first``..``last`` with one version each."""
        return self.replace_days(self.read(first, last).hint("rebalance", DAY), first, last)

    def crowded_days(self, most: int) -> list[int]:
        """Days that more than ``most`` versions make up."""
        return sorted(day for x, versions in self.current().folders.items() if len(versions) > most and (day := day_of(x)) is not None)

    def _change(self, df: DataFrame, merge: Callable[[Commit, dict[str, str]], dict[str, list[str]]], marks: dict[str, int] | None) -> Commit:
        now = self.current()
        version = uuid.uuid4().hex
        rows = df.select(*self.schema.names).withColumn(VERSION, F.lit(version))
        try:
            self._write(rows)
            written = {x.split("/")[-2]: version for x in self.storage.matching(f"{self.data}/*/{VERSION}={version}")}
            new = Commit(now.number, merge(now, written), now.marks | (marks or {}))
            self._publish(new)
        except BaseException:
            for path in self.storage.matching(f"{self.data}/*/{VERSION}={version}"):
                self.storage.delete(path)
            raise
        self._clean()
        return Commit(new.number + 1, new.folders, new.marks)

    def _write(self, rows: DataFrame) -> None:
        """Add files below a folder of their version in each part of the table."""
        rows.write.mode("append").partitionBy(DAY, VERSION).parquet(self.data)

    def _publish(self, commit: Commit) -> None:
        """Make ``commit`` the one after its number."""
        contents = json.dumps({"folders": commit.folders, "marks": commit.marks})
        if not self.storage.write_new(self._commit_file(commit.number + 1), contents):
            raise CommitConflict(f"{self.folder} has a commit {commit.number + 1} already")

    def _clean(self) -> None:
        """Delete commits but the newest ``versions``, and folders that only those named."""
        numbers = self._numbers()
        old, kept = numbers[: -self.versions], numbers[-self.versions :]
        if not old:
            return
        used = {path for number in kept for path in _paths(self._load(number))}
        dropped = {path for number in old for path in _paths(self._load(number))}
        for number in old:
            self.storage.delete(self._commit_file(number))
        for path in sorted(dropped - used):
            self.storage.delete(f"{self.data}/{path}")


def _paths(commit: Commit) -> Iterable[str]:
    return (f"{folder}/{VERSION}={version}" for folder, versions in commit.folders.items() for version in versions)
