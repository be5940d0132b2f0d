"""Two-level aggregation with exact percentiles from a value histogram.

For a measure with few distinct values (hours, days) per group:

1. level 1 groups by ``keys + [value]``: a code-generated hash aggregate
   (partial + final) counts rows and builds every other partial aggregate;
   its output has at most ``groups x distinct values`` rows;
2. a running count per group over the sorted values (a window on that small
   histogram) gives each value its rank interval;
3. level 2 groups by ``keys``: sums / mins / maxes of the level-1 partials,
   and the values at ranks ``floor(p(n-1))`` and ``ceil(p(n-1))`` for each
   percentile, interpolated linearly (``percentile_cont``).

One scan, no per-group value map (Spark's ``percentile`` is an object-hash
aggregate without code generation), exact results.  For measures with many
distinct values use ``percentile.exact_percentiles`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNT = "__c"          # rows per (group, value)
VALUE = "__v"          # the measure value of the histogram row


def nonnull_count() -> Column:
    """Level-2 helper: count of non-null measure values."""
    return F.when(F.col(VALUE).isNotNull(), F.col(COUNT)).otherwise(F.lit(0))


def histogram_aggregate(df: DataFrame, keys: list[str], value: Column, percentiles: dict[str, float],
                        level1: dict[str, Column], level2: dict[str, Column],
                        precision: int = 6) -> DataFrame:
    """``keys`` + ``level2`` columns + one double column per percentile.

    ``level1`` aggregates are computed per (group, value); ``level2``
    expressions aggregate them (and may use ``COUNT``/``VALUE``) per group.
    """
    l1 = (df.withColumn(VALUE, value.cast("double"))
          .groupBy(*keys, VALUE)
          .agg(F.count(F.lit(1)).alias(COUNT), *[e.alias(n) for n, e in level1.items()]))
    nn = nonnull_count()
    w = (Window.partitionBy(*keys).orderBy(F.col(VALUE).asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = (l1.withColumn("__cum", F.sum(nn).over(w))
         .withColumn("__n", F.sum(nn).over(Window.partitionBy(*keys))))
    pct_aggs, pct_cols = [], []
    for name, p in percentiles.items():
        pos = (F.col("__n") - 1) * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        pct_aggs += [F.min(F.when(F.col("__cum") > lo, F.col(VALUE))).alias(f"__lo_{name}"),
                     F.min(F.when(F.col("__cum") > hi, F.col(VALUE))).alias(f"__hi_{name}"),
                     F.max(pos - lo).alias(f"__f_{name}")]
        pct_cols.append(F.round(F.col(f"__lo_{name}")
                                + (F.col(f"__hi_{name}") - F.col(f"__lo_{name}")) * F.col(f"__f_{name}"),
                                precision).alias(name))
    out = h.groupBy(*keys).agg(*pct_aggs, *[e.alias(n) for n, e in level2.items()])
    return out.select(*keys, *level2.keys(), *pct_cols)
