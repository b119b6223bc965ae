"""Keep-first duplicate handling that tolerates one key holding a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same_key(df: DataFrame, other: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [df[k].eqNullSafe(other[f"_{k}"]) for k in keys])


def repeated_keys(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """Keys that occur more than once, with the sequence of their first row. Combined map-side."""
    return (
        df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys])
        .agg(F.min(sequence).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .where("_copies > 1")
        .drop("_copies")
    )


def repeated_keys_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """As :func:`repeated_keys`, where several columns together give the sequence (``_first`` is then a struct).

    The repeated keys are found on the key columns alone, by hash; only their rows enter the aggregate over the whole order.
    """
    counted = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    copies = df.join(counted, _same_key(df, counted, keys), "left_semi")
    return copies.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(F.struct(*order)).alias("_first"))


def mark_repeats(df: DataFrame, keys: list[str], sequence: str | list[str], flag: str) -> DataFrame:
    """Flag every row but the first of its key; NULL keys are equal. ``sequence`` (a column, or several that are compared in turn) must be unique.

    Only keys with copies reach the join, so its right side is as small as the data is clean. How the join runs is left to
    adaptive execution, which knows the size of that side. A hot key is never gathered: its rows stay on the
    streamed side, which adaptive execution splits.
    """
    single = isinstance(sequence, str)
    repeats = repeated_keys(df, keys, sequence) if single else repeated_keys_by(df, keys, sequence)
    here = F.col(sequence) if single else F.struct(*sequence)
    later = F.coalesce(here > F.col("_first"), F.lit(False))
    joined = df.join(repeats, _same_key(df, repeats, keys), "left")
    return joined.withColumn(flag, later).drop("_first", *[f"_{k}" for k in keys])


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the least by ``order``, then by the remaining columns.

    Repeated keys are found on the key columns alone. Only their rows are ranked, and each task hands on its first row of a
    key, so a hot key is a row per task after the shuffle.
    """
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    copies = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    marked = df.join(copies, _same_key(df, copies, keys), "left")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*rest))
    first = marked.where("_copies is not null").select(*df.columns).withColumn("_place", place).where("_place = 1")
    return marked.where("_copies is null").select(*df.columns).unionByName(first.drop("_place"))
