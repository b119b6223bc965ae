"""Small aggregate and ratio expressions.

Means and shares go through double precision on an exactly summed numerator, so results do not depend on
the order in which partitions are merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def rows() -> Column:
    return F.count(F.lit(1))


def rows_where(condition: Column | str) -> Column:
    return F.count_if(as_column(condition))


def ratio(top: Column, bottom: Column) -> Column:
    """Division in doubles; NULL instead of an error when the divisor is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def rounded(value: Column, digits: int) -> Column:
    """Half away from zero on the scaled double, so 3259.135 becomes 3259.14 although its double lies below."""
    scale = float(10**digits)
    return F.round(value.cast("double") * scale) / scale


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded(part.cast("double") * 100 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def mean(value: Column | str, digits: int) -> Column:
    column = as_column(value)
    return rounded(ratio(F.sum(column), F.count(column)), digits)


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def whole(value: Column) -> Column:
    return value.cast("bigint")
