"""Comparison of a Spark result with the rows of its SQL counterpart."""

from __future__ import annotations

import datetime as dt
import math
import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {table} as select * from '{path}'")
    return con


def plain(value):
    """One form per value, keeping numbers apart from text and dates apart from timestamps."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return ("n", float(value))
    if isinstance(value, float):
        return ("n", None if math.isnan(value) else value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def rows_by_name(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_by_name(columns, result.fetchall())
