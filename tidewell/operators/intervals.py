"""Validity intervals: containment joins, neighbours in time and gaps between versions.

Neighbour searches never sort an entity's rows. They first reduce an entity to its distinct dates, a set that
the calendar bounds, and order only those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOREVER = "date '9999-12-31'"


def within_validity(
    events: DataFrame, spans: DataFrame, key: str, moment: str, start: str, end: str, how: str = "inner", bin_days: int | None = None
) -> DataFrame:
    """Events that fall into the span of their key; an open end lasts forever. Equi-join plus residual; ``how`` is inner or left.

    With ``bin_days`` the join also goes by bins of so many days: an event has one bin, a span one row for each bin it reaches between
    the first and the last event. A key with very many events and spans is then spread over as many groups as there are bins, and an event is
    compared only with the spans of its bin. That pays where one key may hold a large share of both sides.
    """
    held = spans.withColumnRenamed(key, f"_{key}")
    day, until = F.to_date(moment), F.coalesce(F.col(end), F.expr(FOREVER))
    inside = (F.col(key) == F.col(f"_{key}")) & (day >= F.col(start)) & (day <= until)
    if bin_days is None:
        return events.join(held, inside, how).drop(f"_{key}")
    bin_of = lambda date: F.floor(F.unix_date(date) / F.lit(bin_days)).cast("int")
    limits = events.agg(F.struct(F.min(day).alias("first"), F.max(day).alias("last")).alias("limits")).scalar()
    first, last = F.greatest(F.col(start), limits["first"]), F.least(until, limits["last"])
    binned = held.withColumn("_bin", F.explode(F.when(first <= last, F.sequence(bin_of(first), bin_of(last)))))
    dated = events.withColumn("_event_bin", bin_of(day))
    return dated.join(binned, inside & (F.col("_event_bin") == F.col("_bin")), how).drop(f"_{key}", "_bin", "_event_bin")


def following_start(rows: DataFrame, entity: str, start: str, tie: str, out: str) -> DataFrame:
    """Start of the next row of the same entity in the order of (start, tie).

    Equal to ``lead(start)``, but rows sharing a start are answered by their highest tie value, and the
    window orders one row per entity and distinct start date.
    """
    days = rows.groupBy(entity, start).agg(F.max(tie).alias("_last"))
    ahead = Window.partitionBy(entity).orderBy(start)
    steps = days.withColumn("_next", F.lead(start).over(ahead))
    steps = steps.select(F.col(entity).alias("_entity"), F.col(start).alias("_start"), "_last", "_next")
    paired = rows.join(steps, (F.col(entity) == F.col("_entity")) & (F.col(start) == F.col("_start")), "left")
    nearest = F.when(F.col(tie) == F.col("_last"), F.col("_next")).otherwise(F.col(start))
    return paired.withColumn(out, nearest).drop("_entity", "_start", "_last", "_next")


def overlaps(contract: DataFrame) -> DataFrame:
    """Contracts whose customer's next contract starts before or on the day this one ends."""
    ordered = following_start(contract, "customer_id", "start_date", "contract_id", "next_start")
    return ordered.where(F.col("next_start") <= F.coalesce("end_date", F.expr(FOREVER))).select(
        "customer_id", "contract_id", "start_date", "end_date", "next_start"
    )


def later_version_gaps(versions: DataFrame, entity: str = "customer_id") -> DataFrame:
    """Number of (closed version, any later version) pairs more than a day apart, per entity.

    Pairs are counted, not built: a closed version matches every version that starts after the later of its own
    start and the day after its end. Starts and thresholds are tallied per entity and date, and one
    running sum over those dates gives the product counts.
    """
    starts = versions.select(entity, F.col("effective_from").alias("day"), F.lit(1).alias("starts"), F.lit(0).alias("asks"))
    closed = versions.where("not is_current and effective_to is not null")
    threshold = F.greatest("effective_from", F.date_add("effective_to", 1))
    asks = closed.select(entity, threshold.alias("day"), F.lit(0).alias("starts"), F.lit(1).alias("asks"))
    tallies = starts.unionByName(asks).groupBy(entity, "day").agg(F.sum("starts").alias("starts"), F.sum("asks").alias("asks"))
    later = Window.partitionBy(entity).orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    counted = tallies.withColumn("_after", F.coalesce(F.sum("starts").over(later), F.lit(0)))
    pairs = counted.groupBy(entity).agg(F.sum(F.col("asks") * F.col("_after")).alias("violations"))
    return pairs.where("violations > 0")


def adjacent_version_gaps(versions: DataFrame, entity: str = "customer_id") -> DataFrame:
    """Number of closed versions whose next version starts more than a day after their end, per entity."""
    closing = F.when(~F.col("is_current"), F.col("effective_to"))
    spans = versions.groupBy(entity, "effective_from", closing.alias("closed_on")).agg(F.count(F.lit(1)).alias("n_rows"))
    later = (
        Window.partitionBy(entity).orderBy(-F.unix_date("effective_from")).rangeBetween(Window.unboundedPreceding, -1)
    )
    steps = spans.withColumn("_next", F.min("effective_from").over(later))
    gaps = steps.where(F.col("_next") > F.date_add("closed_on", 1))
    return gaps.groupBy(entity).agg(F.sum("n_rows").alias("violations"))


def version_gaps(versions: DataFrame, entity: str = "customer_id") -> DataFrame:
    """Closed versions whose next version starts more than a day after their end, with the days between (``gap_days``).

    Versions of one span are one row with their number. The next version is the first that starts later.
    """
    spans = versions.groupBy(entity, "effective_from", F.when(~F.col("is_current"), F.col("effective_to")).alias("effective_to"))
    later = Window.partitionBy(entity).orderBy(F.unix_date("effective_from")).rangeBetween(1, Window.unboundedFollowing)
    steps = spans.agg(F.count(F.lit(1)).alias("n_versions")).withColumn("next_from", F.min("effective_from").over(later))
    gaps = steps.withColumn("gap_days", F.date_diff("next_from", "effective_to")).where("gap_days > 1")
    return gaps.select(entity, "effective_from", "effective_to", "next_from", "gap_days", "n_versions")


def billing_months(contract: DataFrame, horizon: str) -> DataFrame:
    """One due row per contract and month, from the month it starts to its end or the horizon."""
    first = F.to_date(F.trunc("start_date", "month"))
    last = F.coalesce("end_date", F.lit(horizon).cast("date"))
    open_spans = contract.where(last >= first)
    due = F.explode(F.sequence(first, last, F.expr("interval 1 month")))
    return open_spans.select("contract_id", "customer_id", "tariff_id", due.alias("due_month"))
