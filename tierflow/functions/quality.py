"""Data-quality checks: NOT NULL, length bounds, duplicate keys, row counts.

Checks are column predicates, evaluated in one pass; the result is either
counts per rule (one aggregate, no shuffle beyond partial counts), a
quarantine split, or an in-plan failure with ``raise_error``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    ok: Column          # true when the row passes; NULL counts as a pass


def not_null(col: str) -> Rule:
    return Rule(f"not_null:{col}", F.col(col).isNotNull())


def max_length(col: str, n: int) -> Rule:
    return Rule(f"max_length:{col}<={n}", F.col(col).isNull() | (F.length(F.col(col)) <= n))


def rules_for(not_null_cols=(), max_len: dict | None = None) -> list[Rule]:
    rules = [not_null(c) for c in not_null_cols]
    rules += [max_length(c, n) for c, n in (max_len or {}).items()]
    return rules


def _fails(rule: Rule) -> Column:
    return ~F.coalesce(rule.ok, F.lit(True))


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: (rule, violations). A single global aggregate."""
    aggs = [F.sum(F.when(_fails(r), 1).otherwise(0)).cast("bigint").alias(f"r{i}")
            for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{r.name}', r{i}" for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {pairs}) AS (rule, violations)")


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with a ``_failed_rules`` array)."""
    failed = F.filter(
        F.array(*[F.when(_fails(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    )
    tagged = df.withColumn("_failed_rules", failed)
    bad = tagged.filter(F.size("_failed_rules") > 0)
    good = tagged.filter(F.size("_failed_rules") == 0).drop("_failed_rules")
    return good, bad


def enforce(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Fail the job on the first violating row (abort-statement policy).

    The check is part of the plan, so it runs inside the write job itself.
    """
    if not rules:
        return df
    bad = reduce(lambda a, b: a | b, [_fails(r) for r in rules])
    names = F.concat_ws(",", F.filter(
        F.array(*[F.when(_fails(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()))
    guard = F.when(bad, F.raise_error(F.concat(F.lit("quality check failed: "), names)))
    return df.filter(guard.isNull())


def duplicates(df: DataFrame, keys) -> DataFrame:
    """Keys declared unique that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for each named DataFrame; each count is a global aggregate."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
