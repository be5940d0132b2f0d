"""One-pass check operators.

A batch of checks on one table runs as *one* aggregate (conditional sums),
and the single result row is unpivoted with ``stack`` into
``(check_name, violation_count)`` rows, instead of one scan per check.
Grouped checks (uniqueness, accepted values) are partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unpivot(row: DataFrame, names: list[str], value_name: str, label: str = "check_name") -> DataFrame:
    """Turn the one-row frame with columns c0..cN into (label, value) rows."""
    pairs = ", ".join(f"'{n.replace(chr(39), chr(39) * 2)}', `c{i}`" for i, n in enumerate(names))
    return row.selectExpr(f"stack({len(names)}, {pairs}) as (`{label}`, `{value_name}`)")


def count_checks(df: DataFrame, checks: list[tuple[str, Column]],
                 value_name: str = "violation_count") -> DataFrame:
    """Rows violating each predicate, counted in one pass:
    ``[(name, predicate_of_violation), ...]`` -> (check_name, violation_count)."""
    aggs = [F.sum(F.when(pred, 1).otherwise(0)).cast("long").alias(f"c{i}")
            for i, (_, pred) in enumerate(checks)]
    row = df.agg(*aggs)
    row = row.select(*[F.coalesce(F.col(f"c{i}"), F.lit(0).cast("long")).alias(f"c{i}")
                       for i in range(len(checks))])
    return _unpivot(row, [n for n, _ in checks], value_name)


def null_rate_checks(df: DataFrame, checks: list[tuple[str, str]], scale: int = 2) -> DataFrame:
    """``ROUND(SUM(col IS NULL) / COUNT(*) * 100, scale)`` per column, one pass."""
    from ..plans.marts import rnd
    n = F.count(F.lit(1))
    aggs = [rnd(F.sum(F.col(c).isNull().cast("long")).cast("double") / F.nullif(n, F.lit(0)) * 100,
                scale).alias(f"c{i}") for i, (_, c) in enumerate(checks)]
    return _unpivot(df.agg(*aggs), [name for name, _ in checks], "null_pct", "column_check")


def duplicate_count(df: DataFrame, col: str) -> Column:
    """``COUNT(*) - COUNT(DISTINCT col)`` (NULLs count as duplicates)."""
    return (F.count(F.lit(1)) - F.count_distinct(F.col(col))).cast("long")


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """dbt ``unique``: non-null values that occur more than once.
    Returns one row (failing_values, failing_rows)."""
    g = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
         .filter(F.col("n") > 1))
    return g.agg(F.count(F.lit(1)).cast("long").alias("failing_values"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("failing_rows"))


def accepted_values_violations(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """dbt ``accepted_values``: distinct values outside the list (NULL passes).
    Returns one row (failing_values, failing_rows)."""
    g = (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
         .filter(~F.col(col).isin(*values)))
    return g.agg(F.count(F.lit(1)).cast("long").alias("failing_values"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("failing_rows"))


def anti_join_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Orphans: child rows whose key has no parent (NULL keys are orphans)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return (child.join(p, F.col(child_key) == F.col("__pk"), "left_anti")
            .agg(F.count(F.lit(1)).cast("long").alias("orphan_count")))
