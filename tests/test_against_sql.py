"""Every registered query against its SQL counterpart, values and column names."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tidewell.plans import registry
from comparing import connect, oracle_rows, rows_by_name

QUERIES = {name: query for name, query in entry_points.queries().items() if name in registry.queries()}
STATEMENTS = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def sql(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, sql):
    df = QUERIES[name](spark, sf_dir)
    columns, expected = oracle_rows(sql, STATEMENTS[name])
    assert sorted(df.columns) == columns
    assert rows_by_name(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
