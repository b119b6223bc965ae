"""Batch validation: every staged row gets VALID or REJECTED, nothing is dropped."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.measures import as_column, percent
from tidewell.operators.dedup import mark_repeats


@dataclass(frozen=True)
class RowTest:
    """``passes`` must be true for a good row; NULL counts as failed."""

    name: str
    passes: str | Column

    def column(self) -> Column:
        return F.coalesce(as_column(self.passes), F.lit(False))


USAGE_TESTS = (
    RowTest("not_null_contract_id", "contract_id is not null"),
    RowTest("not_null_event_key", "event_key is not null"),
    RowTest("not_null_event_datetime", "event_datetime is not null"),
    RowTest("duration_non_negative", "coalesce(duration_sec, 0) >= 0"),
    RowTest("data_volume_non_negative", "coalesce(data_volume_mb, 0) >= 0"),
    RowTest("fraud_score_in_range", "fraud_score between 0 and 1"),
    RowTest("cost_non_negative", "coalesce(cost, 0) >= 0"),
)
REPEAT_TEST = "no_duplicate_cdr_id"


def stage(batch: DataFrame, load_date: date) -> DataFrame:
    return batch.withColumn("etl_load_date", F.lit(load_date)).withColumn("etl_status", F.lit("PENDING"))


def validate(
    staged: DataFrame,
    tests: tuple[RowTest, ...] = USAGE_TESTS,
    key: str = "cdr_id",
    sequence: str | list[str] = "src_seq",
) -> DataFrame:
    """Set ``etl_status`` on every staged row. The copy test looks at all rows, also those that fail another test."""
    good = reduce(lambda a, b: a & b, [test.column() for test in tests]) & ~F.col("_repeat")
    status = F.when(good, "VALID").otherwise("REJECTED")
    return mark_repeats(staged, [key], sequence, "_repeat").withColumn("etl_status", status).drop("_repeat")


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected)"""
    return validated.where("etl_status = 'VALID'"), validated.where("etl_status = 'REJECTED'")


def report(
    staged: DataFrame,
    tests: tuple[RowTest, ...] = USAGE_TESTS,
    key: str = "cdr_id",
) -> DataFrame:
    """Rows passed and failed per test. Row tests share one pass without a shuffle; copies are counted on the key alone."""

    def line(name: str, ok: Column) -> Column:
        return F.struct(F.lit(name).alias("rule"), ok.alias("passed"), (F.col("_rows") - ok).alias("failed"))

    passed = [F.count_if(test.column()).alias(f"_{i}") for i, test in enumerate(tests)]
    counted = staged.agg(F.count(F.lit(1)).alias("_rows"), *passed)
    by_test = counted.select(F.inline(F.array(*[line(test.name, F.col(f"_{i}")) for i, test in enumerate(tests)])))
    keyed = staged.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    keys = keyed.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("_rows"), F.count(F.lit(1)).alias("_keys"))
    return by_test.unionByName(keys.select(F.inline(F.array(line(REPEAT_TEST, F.col("_keys"))))))


def pass_rate(validated: DataFrame) -> DataFrame:
    """Totals of a batch and its share of valid rows, 0 for an empty batch."""
    total, valid = F.count(F.lit(1)), F.count_if(F.col("etl_status") == "VALID")
    rate = percent(valid, total, 1)
    return validated.agg(
        total.alias("total_rows"),
        valid.alias("valid_rows"),
        (total - valid).alias("rejected_rows"),
        F.coalesce(rate, F.lit(0.0)).alias("pass_pct"),
    )
