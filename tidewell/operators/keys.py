"""Consecutive surrogate keys without sorting a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits


def _running_offsets(sizes: DataFrame, bucket: str) -> DataFrame:
    """Rows in all earlier buckets. ``sizes`` has one row per bucket, so the single-partition window is bounded."""
    earlier = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(bucket, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))


def next_after(df: DataFrame, key: str) -> Column:
    """Largest key so far, never below 0, as a scalar subquery (the unknown member is -1)."""
    return df.agg(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0)).alias("seed")).scalar()


def number_by_id(df: DataFrame, id_column: str, key: str, seed: Column | int = 0, width: int = 65536) -> DataFrame:
    """Add ``key`` = seed + 1, seed + 2, ... in the order of a unique 32-bit ``id_column``.

    Ids are cut into fixed ranges of ``width`` values. A range holds at most ``width`` rows and there are at
    most 2^32 / ``width`` ranges, so neither the per-range window nor the offset window can grow with the data.
    """
    bucket = F.floor(F.col(id_column) / width).cast("bigint")
    stamped = df.withColumn("_bucket", bucket)
    offsets = _running_offsets(stamped.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")), "_bucket")
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(id_column))
    start = F.lit(seed) if isinstance(seed, int) else seed
    return (
        stamped.withColumn("_position", position)
        .join(offsets, "_bucket")
        .withColumn(key, (start + F.col("_offset") + F.col("_position")).cast("bigint"))
        .drop("_bucket", "_position", "_offset")
    )


def stamp_sorted(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` in the order of the columns in ``order``, written once with ``_place`` (sort partition and place in it).

    A global sort range-partitions the rows evenly whatever the key distribution; because the stamped rows are written, retries cannot
    renumber them.
    """
    return materialize(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "numbered")


def number_stamped(placed: DataFrame, key: str, seed: Column | int = 0) -> DataFrame:
    """Add ``key`` = seed + 1, seed + 2, ... to rows of :func:`stamp_sorted`; every sort partition gets a block of keys of its size."""
    placed = placed.withColumn("_part", F.shiftright("_place", _LOCAL_BITS)).withColumn(
        "_position", F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    )
    offsets = _running_offsets(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size")), "_part")
    start = F.lit(seed) if isinstance(seed, int) else seed
    # Offsets have one row per sort partition, which spark.sql.shuffle.partitions bounds: safe to broadcast.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(key, (start + F.col("_offset") + F.col("_position") + 1).cast("bigint"))
        .drop("_part", "_position", "_offset", "_place")
    )


def number_sorted(df: DataFrame, order: list[str], key: str, seed: Column | int = 0) -> DataFrame:
    """Add ``key`` = seed + 1, seed + 2, ... in the order of the columns in ``order``."""
    return number_stamped(stamp_sorted(df, order), key, seed)
