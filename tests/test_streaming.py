"""Streaming results against their batch forms."""

from __future__ import annotations

import os
from datetime import date, timedelta
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidewell.operators.rollup import usage_rollup
from tidewell.operators.validate import validate
from tidewell.plans.fixture_tables import FixtureTables
from tidewell.sources.snapshots import SnapshotTable
from tidewell.streaming import usage


@pytest.fixture(scope="module")
def cdr_files(spark, sf_dir, tmp_path_factory):
    """The usage view cut into time-ordered files, so that several micro-batches arrive in order."""
    folder = str(tmp_path_factory.mktemp("cdr"))
    cdr = FixtureTables(spark, sf_dir)["cdr"]
    for part in range(4):
        cdr.where(f"floor(src_seq * 4 / {cdr.count()}) = {part}").coalesce(1).write.mode("append").parquet(folder)
    return folder, cdr


def stream(spark, cdr_files, per_batch=1):
    folder, cdr = cdr_files
    return spark.readStream.schema(cdr.schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def finish(query, seconds=120):
    assert query.awaitTermination(seconds)
    assert query.exception() is None


def test_quarantine_equals_batch_with_one_file_per_batch(spark, cdr_files, tmp_path):
    paths = [str(tmp_path / name) for name in ("valid", "rejected", "state")]
    run = lambda: usage.quarantine(stream(spark, cdr_files), *paths, date(2024, 1, 31), "s1")
    finish(run())
    expected = validate(cdr_files[1])
    rows = lambda df: sorted(row[0] for row in df.select("src_seq").collect())
    for status, path in zip(("VALID", "REJECTED"), paths, strict=False):
        stored = spark.read.parquet(path)
        assert rows(stored) == rows(expected.where(F.col("etl_status") == status))
        assert stored.select("etl_load_date").distinct().collect() == [(date(2024, 1, 31),)]
    finish(run())  # nothing new: nothing added
    assert sum(spark.read.parquet(path).count() for path in paths[:2]) == cdr_files[1].count()


def test_copies_in_other_batches_are_rejected(spark, tmp_path):
    schema = FixtureTables(spark, "/root/testdata/sf0.001")["cdr"].schema
    one = FixtureTables(spark, "/root/testdata/sf0.001")["valid_cdr"].select(*schema.names).limit(1).collect()[0].asDict()
    folder = str(tmp_path / "in")
    for place in range(3):
        row = one | {"src_seq": place, "event_datetime": one["event_datetime"] + timedelta(days=place)}
        spark.createDataFrame([tuple(row[name] for name in schema.names)], schema).coalesce(1).write.mode("append").parquet(folder)
    paths = [str(tmp_path / name) for name in ("valid", "rejected", "state")]
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    finish(usage.quarantine(source, *paths, date(2024, 1, 31), "s1"))
    assert [spark.read.parquet(path).count() for path in paths[:2]] == [1, 2]
    again = usage.quarantine(source, *paths[:2], str(tmp_path / "state 2"), date(2024, 1, 31), "s2")
    finish(again)  # a new checkpoint keeps what an older one stored
    assert [spark.read.parquet(path).count() for path in paths[:2]] == [1, 5]


def test_what_a_batch_opens_does_not_grow(spark, tmp_path, monkeypatch):
    """Many batches within one day, and days before the look-back: the index stays small and old days are not read."""
    monkeypatch.setattr(usage, "MOST_VERSIONS", 3)
    tables = FixtureTables(spark, "/root/testdata/sf0.001")
    schema = tables["cdr"].schema
    one = tables["valid_cdr"].select(*schema.names).limit(1).collect()[0].asDict()
    folder, opened = str(tmp_path / "in"), []
    days = [0] * 6 + [40] * 3 + [80, 80]
    for place, day in enumerate(days):
        row = one | {"src_seq": place, "cdr_id": place % 9, "event_datetime": one["event_datetime"] + timedelta(days=day)}
        lost = row | {"cdr_id": 100 + place % 2, "event_datetime": None, "src_seq": 1000 + place}
        rows = [tuple(x[name] for name in schema.names) for x in (row, lost)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    read = SnapshotTable.read

    def counted(self, first=None, last=None, commit=None):
        found = read(self, first, last, commit)
        opened.append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(SnapshotTable, "read", counted)
    paths = [str(tmp_path / name) for name in ("valid", "rejected", "state")]
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    finish(usage.quarantine(source, *paths, date(2024, 1, 31), "s1", "31 days"))
    assert max(opened) <= 2 * 4 + 2  # two days of four versions at most
    folders = usage.id_index(spark, paths[0]).current().folders
    assert all(len(versions) <= 3 for versions in folders.values()) and len(folders) == 3
    valid = sorted(x.src_seq for x in spark.read.parquet(paths[0]).select("src_seq").collect())
    # Batch 9 and 10 hold the ids of batches 0 and 1 again, but 80 days later.
    assert valid == list(range(11))


@pytest.fixture
def one_partition(spark):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_on_time_and_late_rows_make_the_batch_rollup(spark, one_partition, tmp_path):
    """More than a hundred micro-batches out of order; a batch given twice changes nothing."""
    cdr = FixtureTables(spark, "/root/testdata/sf0.001")["valid_cdr"].where("event_datetime is not null")
    some = cdr.where("pmod(hash(src_seq), 4) = 0").toPandas()
    order = some.sort_values("event_datetime").reset_index(drop=True)
    late = order.sample(frac=0.2, random_state=1)
    order = pd.concat([order.drop(late.index), late])
    folder, count = str(tmp_path / "in"), 104
    for part in range(count):
        rows = order.iloc[len(order) * part // count : len(order) * (part + 1) // count]
        pq_table = pa.Table.from_pandas(rows, schema=to_arrow_schema(cdr.schema), preserve_index=False)
        Path(folder).mkdir(exist_ok=True)
        pq.write_table(pq_table, f"{folder}/part-{part:03d}.parquet")
        os.utime(f"{folder}/part-{part:03d}.parquet", (1_700_000_000 + part, 1_700_000_000 + part))
    rolled = usage.LateRollup(spark, str(tmp_path / "rolled"), cdr.schema)
    finish(rolled.start(spark.readStream.schema(cdr.schema).option("maxFilesPerTrigger", 1).parquet(folder), str(tmp_path / "state")), 600)
    stored = spark.read.schema(cdr.schema).parquet(folder)
    columns = [x for x in usage_rollup(stored).columns]
    as_rows = lambda df: sorted(map(repr, df.select(*columns).collect()))
    expected = as_rows(usage_rollup(stored))
    assert rolled.parts.current().marks["batch"] == count - 1 >= 100
    assert as_rows(rolled.rollup()) == expected
    found = rolled.late_rows()
    assert found.count() > 0 and as_rows(rolled.rollup(late=False)) != expected
    on_time = stored.join(found.select("src_seq"), "src_seq", "left_anti")
    assert as_rows(usage_rollup(on_time)) == as_rows(rolled.rollup(late=False))
    rolled.store(stored, 3)  # a batch that was stored already
    for _ in range(2):
        rolled.settle(20230101, 20991231)
        assert as_rows(rolled.rollup()) == expected == as_rows(rolled.rollup(late=False))


def test_late_and_bad_rows_are_counted(spark, cdr_files, tmp_path):
    rows = stream(spark, cdr_files)
    good = usage.without_copies(usage.passing(usage.timed(rows)))
    query = usage.append_files(usage.rollup_windows(good), str(tmp_path / "out"), str(tmp_path / "state"))
    finish(query)
    assert usage.late_rows(query) == 0
    bad = usage.append_files(usage.failing(rows), str(tmp_path / "bad"), str(tmp_path / "bad state"))
    finish(bad)
    known = cdr_files[1].count() - usage.passing(cdr_files[1]).count()
    assert spark.read.parquet(str(tmp_path / "bad")).count() == known > 0

    folder, schema = str(tmp_path / "in"), cdr_files[1].schema
    usable = usage.passing(cdr_files[1]).where("location_id is not null").orderBy(F.desc("event_datetime"))
    newest, oldest = usable.limit(1), usable.orderBy("event_datetime").limit(1)
    for part in (newest, oldest, oldest.withColumn("cdr_id", F.col("cdr_id") + 1000000)):
        part.coalesce(1).write.mode("append").parquet(folder)
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = usage.append_files(usage.rollup_windows(usage.timed(files)), str(tmp_path / "out 2"), str(tmp_path / "state 2"))
    finish(query)
    assert usage.late_rows(query) >= 1


def test_rollup_equals_batch_for_closed_windows(spark, cdr_files, tmp_path):
    good = usage.without_copies(usage.passing(usage.timed(stream(spark, cdr_files))))
    finish(usage.append_files(usage.rollup_windows(good), str(tmp_path / "out"), str(tmp_path / "state")))
    ours = spark.read.parquet(str(tmp_path / "out"))
    # Unlike the batch rule, a copy counts as first if the row before it was bad, so compare on the streamed rule.
    kept = usage.passing(cdr_files[1])
    first = kept.groupBy("cdr_id").agg(F.min("src_seq").alias("src_seq"))
    expected = usage_rollup(kept.join(first.select("src_seq"), "src_seq"))
    last = kept.agg(F.max("event_datetime")).collect()[0][0]
    bucket = (last.year * 10000 + last.month * 100 + last.day) * 100
    closed = expected.where(F.col("time_key") < bucket)
    assert closed.count() > 0
    assert sorted(map(tuple, ours.where(F.col("time_key") < bucket).select(*expected.columns).collect())) == sorted(
        map(tuple, closed.collect())
    )


def test_copies_within_the_delay_are_dropped(spark, cdr_files, tmp_path):
    rows = usage.timed(stream(spark, cdr_files)).where("event_datetime is not null")
    finish(usage.append_files(usage.without_copies(rows), str(tmp_path / "out"), str(tmp_path / "state")))
    out = spark.read.parquet(str(tmp_path / "out"))
    source = cdr_files[1].where("event_datetime is not null")
    assert out.count() == source.select("cdr_id").distinct().count() < source.count()
