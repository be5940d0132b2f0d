"""Exact continuous percentiles without putting a group into one task.

Spark's ``percentile`` aggregate keeps a value -> count map per group and
merges it in one task per group: fine when a measure has few distinct values
(hours, days), but a hot group of a continuous measure (a third of all rows
with distinct amounts) would have to fit one task.  Here the work is spread
by *value ranges*:

1. histogram ``(group, value) -> count`` (partial aggregate, skew-safe);
2. range-partition the histogram on ``(group, value)``: a hot group spans
   many partitions; the partition id is stored with the rows
   (``checkpoint()`` into the shared checkpoint folder, so both uses below see
   the same partitioning);
3. per (partition, group) counts form a small table; a prefix sum over
   partition ids gives each (partition, group) its global rank offset;
4. inside each (partition, group) a running count gives global ranks; the
   rows covering ranks ``floor(p(n-1))`` and ``ceil(p(n-1))`` are kept and
   interpolated linearly (``percentile_cont``).

No step holds more than one range partition, and only the offset table is
sized by groups x partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_percentiles(df: DataFrame, keys: list[str], value: str, ps: dict[str, float],
                      partitions: int | None = None, precision: int = 6) -> DataFrame:
    """``keys`` + one column per ``ps`` item (name -> p in [0, 1]), values as
    double rounded to ``precision`` decimals.  NULL values are ignored; a
    group with no values gets NULL."""
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(value).cast("double")
    hist = (df.select(*keys, v.alias("__v")).filter(F.col("__v").isNotNull())
            .groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c")))
    ranged = (hist.repartitionByRange(n_parts, *[F.col(k) for k in keys], F.col("__v"))
              .withColumn("__pid", F.spark_partition_id()))
    _ = spark.sparkContext.getCheckpointDir() or _ensure_checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)

    per_part = ranged.groupBy("__pid", *keys).agg(F.sum("__c").alias("__pc"))
    wk = Window.partitionBy(*keys).orderBy("__pid")
    offsets = (per_part
               .withColumn("__before", F.coalesce(
                   F.sum("__pc").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn("__n", F.sum("__pc").over(Window.partitionBy(*keys)))
               .drop("__pc"))
    local = null_safe_join(ranged, offsets, ["__pid", *keys])
    wl = Window.partitionBy("__pid", *keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    local = local.withColumn("__cum", F.col("__before") + F.sum("__c").over(wl))
    # 0-based rank r is held by the row with cum - c <= r < cum
    aggs, wanted = [], F.lit(False)
    for name, p in ps.items():
        pos = (F.col("__n") - 1) * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        covers_lo = (F.col("__cum") - F.col("__c") <= lo) & (lo < F.col("__cum"))
        covers_hi = (F.col("__cum") - F.col("__c") <= hi) & (hi < F.col("__cum"))
        wanted = wanted | covers_lo | covers_hi
        local = local.withColumn(f"__lo_{name}", F.when(covers_lo, F.col("__v")))
        local = local.withColumn(f"__hi_{name}", F.when(covers_hi, F.col("__v")))
        local = local.withColumn(f"__f_{name}", pos - lo)
        aggs += [F.max(f"__lo_{name}").alias(f"__lo_{name}"), F.max(f"__hi_{name}").alias(f"__hi_{name}"),
                 F.max(f"__f_{name}").alias(f"__f_{name}")]
    picked = local.filter(wanted).groupBy(*keys).agg(*aggs)
    out = [F.round(F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__f_{n}"),
                   precision).alias(n) for n in ps]
    return picked.select(*keys, *out)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (group keys may be NULL);
    the output keeps one copy of each key column."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def _ensure_checkpoint_dir(spark) -> str:
    from ..session import shared_dir
    return shared_dir(spark, "percentile")
