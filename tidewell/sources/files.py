"""Parquet and CSV files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated with a header and no index column."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet_stamped(df: DataFrame, folder: str, name: str, now: datetime) -> str:
    """Write to a new path named after ``now`` and return it."""
    path = f"{folder.rstrip('/')}/{name}_{now:%Y%m%d_%H%M%S}.parquet"
    df.write.parquet(path)
    return path
