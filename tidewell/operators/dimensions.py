"""Slowly changing dimensions as set operations."""

from __future__ import annotations

from datetime import date
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.dedup import keep_first
from tidewell.operators.keys import next_after, number_by_id
from tidewell.session import materialize

CUSTOMER_ATTRIBUTES = (
    "first_name",
    "last_name",
    "gender",
    "birth_date",
    "age",
    "profession",
    "city",
    "country",
    "segment",
    "customer_status",
)
TRACKED = ("profession", "segment")

# The member that facts without a customer point at.
UNKNOWN_MEMBER = (
    "cast(-1 as bigint) as customer_key, -1 as customer_id, 'Unknown' as first_name, 'Unknown' as last_name, "
    "'D' as gender, cast(null as date) as birth_date, cast(null as int) as age, 'Unknown' as profession, "
    "'Unknown' as city, 'Unknown' as country, 'Unknown' as segment, 'Unknown' as customer_status, "
    "date '2000-01-01' as effective_from, cast(null as date) as effective_to, true as is_current"
)


def unknown_customer(spark: SparkSession) -> DataFrame:
    return spark.sql(f"select {UNKNOWN_MEMBER}")


def tariff_rows(tariff: DataFrame, operator: DataFrame) -> DataFrame:
    """Tariff with its operator; tariffs without one do not become members."""
    owner = operator.select("operator_id", "operator_name", F.col("country").alias("operator_country"))
    return tariff.join(owner, "operator_id").select(
        F.col("tariff_id").alias("tariff_key"),
        "tariff_id",
        "tariff_name",
        "tariff_type",
        "monthly_fee",
        "free_minutes",
        "free_sms",
        "data_mb",
        "operator_name",
        "operator_country",
    )


def location_rows(location: DataFrame) -> DataFrame:
    return location.select(
        F.col("location_id").alias("location_key"),
        "location_id",
        "country",
        "region",
        "city",
        "cell_tower_id",
        "area_type",
        F.col("latitude").cast("decimal(10,6)").alias("latitude"),
        F.col("longitude").cast("decimal(10,6)").alias("longitude"),
    )


def event_rows(event_type: DataFrame) -> DataFrame:
    return event_type.select("event_key", "event_name", "event_category", "is_chargeable", "fraud_risk_level")


def channel_rows(channel: DataFrame) -> DataFrame:
    return channel.withColumnRenamed("channel_id", "channel_key")


def overwrite_by_key(existing: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Type 1: source rows replace members of the same key, all other members stay."""
    return source.unionByName(existing.join(source, key, "left_anti"))


def one_per_entity(source: DataFrame, entity: str = "customer_id", newest_by: str | None = None) -> DataFrame:
    """One row for each entity: the newest by the date or timestamp ``newest_by`` (rows without one come last), then by the other columns."""
    if newest_by is None:
        return keep_first(source, [entity], [])
    age = F.coalesce(-F.unix_micros(F.col(newest_by).cast("timestamp")), F.lit((1 << 63) - 1))
    return keep_first(source.withColumn("_age", age), [entity], ["_age"]).drop("_age")


def ambiguous_entities(dimension: DataFrame, entity: str = "customer_id") -> DataFrame:
    """Entities with more than one current version."""
    current = dimension.where("is_current").groupBy(entity).agg(F.count(F.lit(1)).alias("n_current"))
    return current.where("n_current > 1")


def _compare(existing: DataFrame, source: DataFrame, entity: str, tracked: tuple[str, ...]) -> DataFrame:
    """Current versions and source rows side by side, with ``_new`` and ``_changed``."""
    now = existing.where("is_current").selectExpr(*[f"{c} as _{c}" for c in existing.columns])
    pairs = now.join(source, F.expr(f"_{entity} = {entity}"), "full_outer")
    differs = " or ".join(f"not (_{c} <=> {c})" for c in tracked)
    return pairs.selectExpr(
        "*",
        f"_{entity} is null as _new",
        f"_{entity} is not null and {entity} is not null and ({differs}) as _changed",
    )


def _opening(rows: DataFrame, load_date: date, entity: str, attributes: tuple[str, ...]) -> DataFrame:
    opened = (f"date '{load_date}' as effective_from", "cast(null as date) as effective_to", "true as is_current")
    return rows.selectExpr(entity, *attributes, *opened)


def first_versions(
    unknown: DataFrame,
    source: DataFrame,
    load_date: date,
    key: str = "customer_key",
    entity: str = "customer_id",
    attributes: tuple[str, ...] = CUSTOMER_ATTRIBUTES,
) -> DataFrame:
    """Type 2, first load: :func:`apply_versions` on a dimension that only has its unknown member, without the join."""
    numbered = number_by_id(_opening(source, load_date, entity, attributes), entity, key)
    return unknown.unionByName(numbered)


def apply_versions(
    existing: DataFrame,
    source: DataFrame,
    load_date: date,
    key: str = "customer_key",
    entity: str = "customer_id",
    attributes: tuple[str, ...] = CUSTOMER_ATTRIBUTES,
    tracked: tuple[str, ...] = TRACKED,
    cut: bool = False,
) -> DataFrame:
    """Type 2: the dimension after ``source`` arrived on ``load_date``.

    New entities open a version; a change in a tracked attribute closes the current version the day before
    and opens the next one. Entities missing from the source and untracked changes leave the dimension as it
    is. One full outer join decides everything. ``source`` must hold each entity once and ``existing`` at most
    one current version of each. With ``cut`` the comparison is written once instead of being evaluated for
    kept and opened versions separately.
    """
    pairs = _compare(existing, source.select(entity, *attributes), entity, tracked)
    if cut:
        pairs = materialize(pairs, "versions")
    replaced = {
        "effective_to": f"case when _changed then date_sub(date '{load_date}', 1) else _effective_to end",
        "is_current": "not _changed",
    }
    kept = pairs.where("not _new").selectExpr(*[f"{replaced.get(c, f'_{c}')} as {c}" for c in existing.columns])
    opened = _opening(pairs.where("_new or _changed"), load_date, entity, attributes)
    numbered = number_by_id(opened, entity, key, next_after(existing, key)).select(*existing.columns)
    return existing.where("not is_current").unionByName(kept).unionByName(numbered)


def version_changes(
    existing: DataFrame,
    source: DataFrame,
    entity: str = "customer_id",
    attributes: tuple[str, ...] = CUSTOMER_ATTRIBUTES,
    tracked: tuple[str, ...] = TRACKED,
) -> DataFrame:
    """The source rows that open a version; ``_changed`` where they close one as well. All that :func:`apply_changes` needs."""
    pairs = _compare(existing, source.select(entity, *attributes), entity, tracked)
    return pairs.where("_new or _changed").select(entity, *attributes, "_changed")


def apply_changes(
    part: DataFrame,
    changes: DataFrame,
    load_date: date,
    seed: Column | int,
    key: str = "customer_key",
    entity: str = "customer_id",
    attributes: tuple[str, ...] = CUSTOMER_ATTRIBUTES,
) -> DataFrame:
    """Type 2 by parts: ``part`` of a dimension, with all versions of the entities in ``changes``, after those changes.

    New keys follow ``seed``, in the order of the entities, so they do not depend on which part is looked at. The result for the whole
    dimension is that of :func:`apply_versions`. ``changes`` must be a written table, because it is read several times.
    """
    closing = changes.where("_changed").select(entity, F.lit(True).alias("_closing"))
    ends = "(is_current and _closing is not null)"
    replaced = {
        "effective_to": f"case when {ends} then date_sub(date '{load_date}', 1) else effective_to end",
        "is_current": f"is_current and not {ends}",
    }
    kept = part.join(closing, entity, "left").selectExpr(*[f"{replaced.get(c, c)} as {c}" for c in part.columns])
    opened = number_by_id(_opening(changes, load_date, entity, attributes), entity, key, seed)
    return kept.unionByName(opened.select(*part.columns))


def version_activity(existing: DataFrame, source: DataFrame, entity: str = "customer_id", tracked: tuple[str, ...] = TRACKED) -> DataFrame:
    """How many versions a load would close and insert."""
    return _compare(existing, source, entity, tracked).agg(
        F.count_if("_changed").alias("closed"), F.count_if(F.col("_new") | F.col("_changed")).alias("inserted")
    )
