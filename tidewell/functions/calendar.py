"""Calendar keys and attributes."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The public holidays flagged in the 2024 calendar, and the name of each six-hour bucket.
HOLIDAYS_2024 = (
    date(2024, 1, 1),
    date(2024, 1, 6),
    date(2024, 4, 1),
    date(2024, 5, 1),
    date(2024, 5, 9),
    date(2024, 5, 20),
    date(2024, 8, 15),
    date(2024, 10, 26),
    date(2024, 11, 1),
    date(2024, 12, 8),
    date(2024, 12, 25),
    date(2024, 12, 26),
)
# Holidays on one date each year (month, day), and those at a distance in days from Easter Sunday.
YEARLY_HOLIDAYS = ((1, 1), (1, 6), (5, 1), (8, 15), (10, 26), (11, 1), (12, 8), (12, 25), (12, 26))
EASTER_HOLIDAYS = (1, 39, 50)
DAYPARTS = {0: "Night", 6: "Morning", 12: "Afternoon", 18: "Evening"}


def easter_sunday(year: int) -> date:
    """The Sunday after the first ecclesiastical full moon from 21 March on (Gregorian calendar)."""
    century = year // 100
    skipped, corrected = century - century // 4, (8 * century + 13) // 25
    moon_age = (19 * (year % 19) + skipped - corrected + 15) % 30
    moon_age -= moon_age == 29 or (moon_age == 28 and year % 19 > 10)
    full_moon = date(year, 3, 21) + timedelta(days=moon_age)
    return full_moon + timedelta(days=7 - (full_moon.weekday() + 1) % 7)


def holidays_of(year: int) -> tuple[date, ...]:
    """Public holidays of a year by the same rules that give :data:`HOLIDAYS_2024`."""
    easter = easter_sunday(year)
    movable = [easter + timedelta(days=days) for days in EASTER_HOLIDAYS]
    return tuple(sorted([date(year, *day) for day in YEARLY_HOLIDAYS] + movable))


def day_number(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def time_key(moment: Column) -> Column:
    """yyyymmddhh of the six-hour bucket that holds ``moment``."""
    hour = F.hour(moment)
    return day_number(moment) * 100 + (hour - hour % 6)


def _attributes(days: DataFrame, holidays: tuple[date, ...]) -> DataFrame:
    day = F.col("date_val")
    daypart = F.coalesce(*[F.when(F.col("hour") == hour, F.lit(name)) for hour, name in DAYPARTS.items()])
    hours = F.array(*[F.lit(hour) for hour in DAYPARTS])
    return days.select(day, F.explode(hours).alias("hour")).select(
        (day_number(day) * 100 + F.col("hour")).cast("int").alias("time_key"),
        day,
        F.day(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week"),
        F.format_string("W%02d", F.weekofyear(day)).alias("week_name"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        day.isin(*holidays).alias("holiday_flag"),
        daypart.alias("time_of_day"),
        F.col("hour"),
    )


def calendar(spark: SparkSession, start: date, end: date, holidays: tuple[date, ...] = HOLIDAYS_2024) -> DataFrame:
    """Four rows for every day from ``start`` to ``end``."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_val"))
    return _attributes(days, holidays)


def calendar_covering(events: DataFrame, moment: str, holidays: tuple[date, ...] = HOLIDAYS_2024) -> DataFrame:
    """Calendar of all whole years that ``events`` touches; only the time column is scanned."""
    span = events.agg(F.min(moment).alias("lo"), F.max(moment).alias("hi"))
    first = F.to_date(F.trunc("lo", "year"))
    last = F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1)
    days = span.where("lo is not null").select(F.explode(F.sequence(first, last)).alias("date_val"))
    return _attributes(days, holidays)
