"""Row counts across tables and layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_tables(tables: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """(layer, table_name, row_count); each table is reduced to one row before the union."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
        for layer, name, df in tables
    ]
    return reduce(DataFrame.unionByName, counted)


def side_by_side(counts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Turn named counts into one row; ``columns`` maps output column to table name."""
    return counts.agg(
        *[F.coalesce(F.max(F.when(F.col("table_name") == name, F.col("row_count"))), F.lit(0)).alias(out) for out, name in columns.items()]
    )
