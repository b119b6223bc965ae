"""Declarative checks: row rules fused into one aggregation per table, and referential rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A counted condition over one table, in SQL text.

    ``condition`` is true for rows that break the rule; ``measure`` replaces it where the count is an
    aggregate of another form. ``passes`` says when the count is acceptable.
    """

    rule_id: str
    name: str
    condition: str | None = None
    severity: str = "FAIL"
    measure: str | None = None
    passes: str = "failed_rows = 0"

    def count(self) -> str:
        return f"cast({self.measure} as bigint)" if self.measure else f"count_if({self.condition})"


@dataclass(frozen=True)
class Reference:
    """A child column that must exist in a parent column."""

    rule_id: str
    name: str
    column: str
    parent: str
    parent_column: str
    severity: str = "FAIL"


def _verdict(rule: Rule | Reference, failed: str) -> str:
    """Text of the result row of one rule whose count is in column ``failed``."""
    passes = getattr(rule, "passes", "failed_rows = 0").replace("failed_rows", failed)
    status = f"case when {passes} then 'PASS' else '{rule.severity}' end"
    return (
        f"named_struct('rule_id', '{rule.rule_id}', 'check_name', '{rule.name}', "
        f"'failed_rows', {failed}, 'status', {status})"
    )


def check_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Evaluate all ``rules`` in one scan of ``df``; one output row per rule."""
    counted = df.selectExpr(*[f"{rule.count()} as n{i}" for i, rule in enumerate(rules)])
    lines = ", ".join(_verdict(rule, f"n{i}") for i, rule in enumerate(rules))
    return counted.selectExpr(f"inline(array({lines}))")


def check_total(counted: DataFrame, rule: Rule) -> DataFrame:
    """Wrap a frame whose rows are the violations (or whose ``violations`` column counts them)."""
    total = "coalesce(sum(violations), 0)" if "violations" in counted.columns else "count(*)"
    return counted.selectExpr(f"cast({total} as bigint) as n").selectExpr(f"inline(array({_verdict(rule, 'n')}))")


def repeated_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def orphan_counts(
    child: DataFrame, references: list[Reference], parents: dict[str, DataFrame], nulls_are_lost: bool = True
) -> DataFrame:
    """(rule_id, failed_rows) for every reference of one child table, in one scan of it.

    Child rows are counted per (rule, key) before anything is shuffled, so a hot or missing key travels as
    one row per task; the anti-join then runs on distinct keys. A NULL key has no parent, unless nulls are allowed.
    """
    pairs = ", ".join(f"named_struct('rule_id', '{r.rule_id}', 'key', cast({r.column} as bigint))" for r in references)
    tallies = child.selectExpr(f"inline(array({pairs}))").groupBy("rule_id", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    if not nulls_are_lost:
        tallies = tallies.where("key is not null")
    known = reduce(
        DataFrame.unionByName,
        [
            parents[r.parent].selectExpr(f"'{r.rule_id}' as rule_id", f"cast({r.parent_column} as bigint) as key")
            for r in references
        ],
    )
    lost = tallies.join(known, ["rule_id", "key"], "left_anti").select("rule_id", "n_rows")
    named = ", ".join(f"('{r.rule_id}', 0L)" for r in references)
    zero = child.sparkSession.sql(f"select * from values {named} as zero(rule_id, n_rows)")
    return lost.unionByName(zero).groupBy("rule_id").agg(F.sum("n_rows").alias("failed_rows"))


def orphan_counts_by_key(child: DataFrame, references: list[Reference], parent: DataFrame, nulls_are_lost: bool = True) -> DataFrame:
    """(rule_id, failed_rows) for references that share their column and parent, joined on the parent's own key column.

    A parent in hash buckets of that column is not shuffled: only the child's distinct keys move, already counted. A key that the parent's
    type cannot hold has no parent.
    """
    column, key = references[0].column, references[0].parent_column
    held = F.expr(f"try_cast({column} as {parent.schema[key].dataType.simpleString()})")
    counted = F.count(F.lit(1)) if nulls_are_lost else F.count(column)
    tallies = child.select(column, held.alias("_key")).groupBy("_key").agg(counted.alias("n_rows"))
    lost = tallies.join(parent.select(F.col(key).alias("_parent")), F.col("_key") == F.col("_parent"), "left_anti")
    rules = ", ".join(f"'{r.rule_id}'" for r in references)
    total = lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failed_rows"))
    return total.selectExpr(f"explode(array({rules})) as rule_id", "failed_rows")


def check_references(
    child: DataFrame,
    references: list[Reference],
    parents: dict[str, DataFrame],
    nulls_are_lost: bool = True,
    in_buckets: Mapping[tuple[str, str], DataFrame] | None = None,
) -> DataFrame:
    """One row for each reference. Parents in ``in_buckets``, by name and key column, are joined on their buckets, all others in one scan."""
    by_key: dict[tuple[str, str, str], list[Reference]] = {}
    for r in references:
        if (r.parent, r.parent_column) in (in_buckets or {}):
            by_key.setdefault((r.column, r.parent, r.parent_column), []).append(r)
    together = [r for r in references if (r.column, r.parent, r.parent_column) not in by_key]
    parts = [orphan_counts_by_key(child, same, in_buckets[place[1:]], nulls_are_lost) for place, same in by_key.items()]
    if together:
        parts.append(orphan_counts(child, together, parents, nulls_are_lost))
    counts = reduce(DataFrame.unionByName, parts)
    lines = " ".join(f"when '{r.rule_id}' then {_verdict(r, 'failed_rows')}" for r in references)
    return counts.selectExpr(f"case rule_id {lines} end as line").select("line.*")


def summarize(checks: DataFrame) -> DataFrame:
    """One row: how many checks passed, failed or warned; only a FAIL makes the whole suite fail."""
    failed = F.count_if(F.col("status") == "FAIL")
    return checks.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        failed.alias("failed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("overall"),
    )
