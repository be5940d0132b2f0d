"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records uniformly, by a seeded hash of their position in
the input, into buckets that fit in one task's memory.  Pass 2 shuffles every
bucket with Fisher-Yates (Spark's ``shuffle``) and writes it at once.  The
buckets, laid end to end, are a random order of all records; shard ``s`` of
``n`` takes the records from ``s/n`` to ``(s+1)/n`` of that order, so shard
sizes differ by one row at most, and a bucket is written to one shard, or to two
where a border runs through it.

The position is the scan position (``monotonically_increasing_id``), so a row
that is repeated any number of times still spreads over all buckets.  The input
has to be a stored table: both passes scan it, and a re-run task sees the same
positions.  The counts written are compared with the counts planned, and a
difference raises.

Nulls: a null text counts no bytes; null ids are ordinary records.  An empty
table gives an empty result.  The record travels as one struct, so columns of
any name cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import new_folder

BUCKET_BYTES = 16 << 20


def record_bytes(text_col: str):
    return F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long") + 1


def two_pass_shuffle(spark: SparkSession, docs: DataFrame, n_shards: int, seed: int = 17,
                     bucket_bytes: int = BUCKET_BYTES, text_col: str = "text",
                     path: str | None = None) -> DataFrame:
    """Write ``docs`` in random order to ``n_shards`` shards under ``path``.

    Returns the written table: ``record`` (a struct of the input's columns),
    ``slot`` (place in the shard, gapless from 0) and ``shard``.
    """
    path = path or new_folder(spark, "shards")
    total = docs.agg(F.sum(record_bytes(text_col)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    n_rows, n_buckets = total.n, max(1, -(-(total.b or 0) // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col("pos")), F.lit(n_buckets))

    counts = (docs.select(F.monotonically_increasing_id().alias("pos"))
              .groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
    # one row per bucket, and a bucket holds many megabytes: a small table
    starts = counts.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("start"))

    scattered = (docs.select(F.monotonically_increasing_id().alias("pos"), F.struct("*").alias("record"))
                 .select(bucket.alias("bucket"), "pos", "record")
                 .repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "pos"))
    dealt = (scattered.groupBy("bucket").agg(F.collect_list("record").alias("records"))
             .join(starts, "bucket")
             .select("start", F.posexplode(F.shuffle("records", seed)).alias("i", "record"))
             .withColumn("place", F.col("start") + F.col("i")))
    # shard s holds the places from ceil(s * rows / shards) on
    shard = F.expr(f"cast((place * {n_shards}L) div {max(n_rows, 1)}L as int)")
    first = F.expr(f"(shard * {max(n_rows, 1)}L + {n_shards - 1}L) div {n_shards}L")
    (dealt.withColumn("shard", shard).withColumn("slot", F.col("place") - first)
     .select("record", "slot", "shard").write.partitionBy("shard").parquet(path))

    schema = dealt.select("record", F.col("place").alias("slot"), F.lit(0).alias("shard")).schema
    written = spark.read.schema(schema).parquet(path)
    for r in written.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("lo"),
                                          F.max("slot").alias("hi")).collect():
        lo, hi = (-(-(s * n_rows) // n_shards) for s in (r.shard, r.shard + 1))
        if (r.n, r.lo, r.hi) != (hi - lo, 0, hi - lo - 1):
            raise RuntimeError("the input changed between the two passes; store it first")
    return written
