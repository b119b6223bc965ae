"""Streaming forms: quarantine per micro-batch, bounded duplicate removal and the six-hour roll-up."""

from __future__ import annotations

import json
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from tidewell.functions.calendar import time_key
from tidewell.functions.rating import SMS_EVENT, VOICE_EVENTS
from tidewell.operators.rollup import ROLLUP_KEYS, usage_rollup
from tidewell.operators.validate import USAGE_TESTS, RowTest, stage, validate
from tidewell.session import materialize
from tidewell.sources.snapshots import SnapshotTable

BUCKET = "6 hours"
#: A day of an index or roll-up that is made up of more versions (one for each micro-batch that touched it) is rewritten as one.
MOST_VERSIONS = 32
IDS = "cdr_id long, stream string, batch long, day int"


def _day(moment: str | Column) -> Column:
    return F.date_format(moment, "yyyyMMdd").cast("int")


def _compact(table: SnapshotTable) -> None:
    for day in table.crowded_days(MOST_VERSIONS):
        table.compact(day, day)


def timed(stream: DataFrame, moment: str = "event_datetime", delay: str = "1 hour") -> DataFrame:
    """Set the one watermark that the stateful steps below share. It needs a zoned timestamp (session zone UTC)."""
    return stream.withColumn(moment, F.col(moment).cast("timestamp")).withWatermark(moment, delay)


def passing(stream: DataFrame, tests: tuple[RowTest, ...] = USAGE_TESTS) -> DataFrame:
    """Rows that pass every row test. The copy test needs state and comes after."""
    return stream.where(reduce(lambda a, b: a & b, [test.column() for test in tests]))


def failing(stream: DataFrame, tests: tuple[RowTest, ...] = USAGE_TESTS) -> DataFrame:
    """The rows that :func:`passing` leaves out, for a quarantine of their own."""
    return stream.where(~reduce(lambda a, b: a & b, [test.column() for test in tests]))


def without_copies(stream: DataFrame, key: str = "cdr_id") -> DataFrame:
    """Drop later copies of ``key``. State is kept for the watermark delay; copies further apart pass."""
    return stream.dropDuplicatesWithinWatermark([key])


def rollup_windows(stream: DataFrame, moment: str = "event_datetime") -> DataFrame:
    """The batch roll-up over six-hour tumbling windows, for append mode. ``stream`` holds valid rows."""
    rows = stream.where("location_id is not null")
    grouped = rows.groupBy(F.window(moment, BUCKET).alias("w"), "contract_id", "event_key", "location_id").agg(
        F.count_if(F.col("event_key").isin(*VOICE_EVENTS)).alias("call_count"),
        F.count_if(F.col("event_key") == SMS_EVENT).alias("sms_count"),
        F.sum("duration_sec").alias("seconds"),
        F.sum("data_volume_mb").alias("megabytes"),
        F.sum("cost").alias("amount"),
        F.max("fraud_score").alias("fraud_score"),
        F.count("cdr_id").alias("event_count"),
    )
    return grouped.select(
        "contract_id",
        time_key(F.col("w.start")).alias("time_key"),
        "event_key",
        "location_id",
        "call_count",
        "sms_count",
        F.coalesce("seconds", F.lit(0)).cast("bigint").alias("total_call_duration_sec"),
        F.coalesce("megabytes", F.lit(0)).cast("decimal(18,2)").alias("total_data_volume_mb"),
        F.coalesce("amount", F.lit(0)).cast("decimal(18,2)").alias("revenue_amount"),
        "fraud_score",
        "event_count",
    )


def quarantine(
    stream: DataFrame,
    valid_path: str,
    rejected_path: str,
    checkpoint: str,
    load_date: date,
    stream_id: str,
    lookback: str = "31 days",
) -> StreamingQuery:
    """Validate each micro-batch into a valid and a rejected table, as the batch form does over all rows at once.

    A row whose id came in an earlier batch is a copy, whatever became of the first one. Ids are kept in an index beside the valid table
    (``<valid_path>_ids``), by day of the event and, for rows without one, by the newest day known by then. A batch is compared with the days from
    ``lookback`` before its earliest event on, by the index's ids alone; no stored batch is opened. A day of the index never has more than
    :data:`MOST_VERSIONS` versions, so what a batch opens is bounded by the look-back. Every batch owns one folder below
    ``stream=<stream_id>`` that a retry overwrites with the same rows; a new checkpoint takes a new ``stream_id``.
    """
    ids = id_index(stream.sparkSession, valid_path)
    if not ids.exists():
        ids.create()

    def store(batch: DataFrame, batch_id: int) -> None:
        marked = materialize(validate(stage(batch, load_date)), "batch")
        since = F.min("event_datetime") - F.expr(f"interval {lookback}")
        span = marked.agg(_day(since).alias("since"), _day(F.max("event_datetime")).alias("newest")).collect()[0]
        commit = ids.current()
        newest = max(span["newest"] or 0, commit.marks.get("newest", int(f"{load_date:%Y%m%d}") if not span["newest"] else 0))
        first = span["since"] or _days_before(marked.sparkSession, newest, lookback)
        seen = ids.read(first, commit=commit).where(~((F.col("stream") == stream_id) & (F.col("batch") >= batch_id)))
        seen = seen.select(F.col("cdr_id").alias("seen_id"), F.lit(True).alias("seen")).distinct()
        known = marked.join(seen, marked["cdr_id"].eqNullSafe(seen["seen_id"]), "left")
        status = F.when(F.col("seen").isNotNull(), "REJECTED").otherwise(F.col("etl_status"))
        judged = materialize(known.withColumn("etl_status", status).select(*marked.columns), "batch")
        for status, path in (("VALID", valid_path), ("REJECTED", rejected_path)):
            part = judged.where(F.col("etl_status") == status)
            part.write.mode("overwrite").parquet(f"{path}/stream={stream_id}/batch_id={batch_id}")
        if commit.marks.get(f"batch {stream_id}", -1) < batch_id:  # else a retry: the ids are there
            own = judged.select("cdr_id", F.coalesce(_day("event_datetime"), F.lit(newest)).alias("day")).distinct()
            own = own.withColumns({"stream": F.lit(stream_id), "batch": F.lit(batch_id).cast("long")})
            ids.append(own.hint("rebalance", "day"), {f"batch {stream_id}": batch_id, "newest": newest})
            _compact(ids)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def id_index(spark: SparkSession, valid_path: str) -> SnapshotTable:
    """The ids that :func:`quarantine` has stored, by day."""
    return SnapshotTable(spark, f"{valid_path}_ids", StructType.fromDDL(IDS))


def _days_before(spark: SparkSession, day: int, lookback: str) -> int:
    then = F.to_date(F.lit(str(day)), "yyyyMMdd").cast("timestamp") - F.expr(f"interval {lookback}")
    return spark.range(1).select(_day(then).alias("day")).collect()[0]["day"]


class LateRollup:
    """The six-hour roll-up of a stream that loses no late row.

    Every micro-batch adds its own roll-up as partial rows; all measures are sums, counts or maxima, so the sum of the partial rows is the
    roll-up whatever the batches were. A bucket is closed once the newest event is ``delay`` past its end. Partial rows of closed buckets are
    marked ``late``, and the rows they come from are kept in a table of their own. :meth:`settle` folds late partial rows into their days.

    A batch takes effect with one commit that also notes its number and the newest event, so a retried batch changes nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, rows: StructType, delay: str = "1 hour"):
        self.spark, self.delay = spark, delay
        empty = usage_rollup(spark.createDataFrame([], rows))
        kept = [StructField(x.name, x.dataType) for x in empty.schema]
        own = [StructField("late", BooleanType()), StructField("batch", LongType()), StructField("day", IntegerType())]
        self.parts = SnapshotTable(spark, f"{folder}/parts", StructType([*kept, *own]))
        self.late = SnapshotTable(spark, f"{folder}/late", StructType([*rows.fields, *own[1:]]))
        for table in (self.parts, self.late):
            if not table.exists():
                table.create()

    def store(self, batch: DataFrame, batch_id: int) -> None:
        """Add one micro-batch of valid rows."""
        commit = self.parts.current()
        if commit.marks.get("batch", -1) >= batch_id:
            return
        newest = commit.marks.get("newest")  # microseconds, before this batch
        rows = materialize(batch.where("event_datetime is not null and location_id is not null"), "batch")
        moment = F.col("event_datetime").cast("timestamp")
        bucket_end = F.window(moment, BUCKET)["end"]
        passed = F.lit(False) if newest is None else bucket_end + F.expr(f"interval {self.delay}") <= F.timestamp_micros(F.lit(newest))
        dated = rows.withColumns({"late": passed, "batch": F.lit(batch_id).cast("long"), "day": _day("event_datetime")})
        seen, n_late = dated.agg(F.unix_micros(F.max(moment)), F.count_if("late")).collect()[0]
        if n_late and self.late.current().marks.get("batch", -1) < batch_id:
            self.late.append(dated.where("late"), {"batch": batch_id})
            _compact(self.late)
        halves = [usage_rollup(dated.where(F.col("late") == x)).withColumn("late", F.lit(x)) for x in ((False, True) if n_late else (False,))]
        parts = reduce(DataFrame.unionByName, halves).withColumns(
            {"batch": F.lit(batch_id).cast("long"), "day": F.floor(F.col("time_key") / 100).cast("int")}
        )
        known = [x for x in (newest, seen) if x is not None]
        self.parts.append(parts, {"batch": batch_id} | ({"newest": max(known)} if known else {}))
        _compact(self.parts)

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.store).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()

    def rollup(self, late: bool = True) -> DataFrame:
        """The roll-up as far as it has come; without ``late`` only what came before its bucket was closed."""
        parts = self.parts.read()
        return _merged(parts if late else parts.where("not late")).drop("day")

    def late_rows(self) -> DataFrame:
        """The rows that came after their bucket was closed, with their batch."""
        return self.late.read().drop("day")

    def settle(self, first: int, last: int) -> None:
        """Make one row of all partial rows of a key in the days ``first``..``last``; the roll-up stays the same, also if this is repeated."""
        merged = _merged(self.parts.read(first, last)).withColumns({"late": F.lit(False), "batch": F.lit(None).cast("long")})
        self.parts.replace_days(merged, first, last)


def _merged(parts: DataFrame) -> DataFrame:
    """One row for each key of the roll-up."""
    others = [x for x in parts.columns if x not in (*ROLLUP_KEYS, "late", "batch", "day")]
    kinds = {x.name: x.dataType for x in parts.schema}
    sums = [(F.max(x) if x == "fraud_score" else F.sum(x)).cast(kinds[x]).alias(x) for x in others]
    return parts.groupBy(*ROLLUP_KEYS, "day").agg(*sums)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark and were left out, as far as the progress of ``query`` is kept (:class:`LateRollup` keeps the rows)."""
    return sum(
        operator["numRowsDroppedByWatermark"] for progress in query.recentProgress for operator in json.loads(progress.json)["stateOperators"]
    )


def append_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.option("path", path).trigger(availableNow=True).start()
