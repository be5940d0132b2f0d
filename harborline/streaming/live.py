"""Structured Streaming versions of the near-real-time tables and the
incremental fact (survey E11, M1-M6).

* Sources are file streams over bronze folders (Parquet), so a new file is a
  new micro-batch; ``trigger(processingTime=...)`` gives the target lag in
  production (``streaming.live_run``), ``availableNow`` drains what is there.
* Every sink is ``foreachBatch`` into a ``ChangelogTable``: each micro-batch
  writes only its rows, into a folder named by its batch id (a replayed batch
  overwrites its own folder, so the sinks are exactly-once on top of the
  checkpoint); readers fold the log to the latest row per key.
* ``dt_port_congestion`` sums each micro-batch per port and 15-minute pane into a
  ``PaneLog``; the sliding 24-hour windows are put together from the panes when they
  are read.  Sums of batches add up in any order, so a late row counts in every window
  it belongs to: there is no state to drop it from.  Late rows are counted.
* Refreshes are logged by ``streaming.refresh_log``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import domain as d
from ..operators.incremental import ChangelogTable, PaneLog
from ..operators.panes import pane_of, pane_start, sliding_sums
from ..plans import facts, live, staging
from ..plans.marts import pct_of, rnd

# Target lag of the live tables in minutes (M3): their triggers and their lag report.
TARGET_LAG = {"dt_active_shipments": 5.0, "dt_port_congestion": 15.0}


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(path))


def stage_batches(df: DataFrame, path: str, order_col: str, n_batches: int = 3,
                  files_per_batch: int = 2, redeliver_share: int = 0) -> None:
    """Write ``df`` as ``n_batches`` successive appends ordered by
    ``order_col`` (each append = later files = later micro-batches).
    ``redeliver_share`` > 0 re-sends 1/share of each batch's rows again with
    the next batch (duplicate delivery)."""
    day = F.datediff(F.to_date(order_col), F.lit("1970-01-01").cast("date")).cast("double")
    bounds = df.select(day.alias("__d")).approxQuantile(
        "__d", [i / n_batches for i in range(1, n_batches)], 0.001) if n_batches > 1 else []
    edges = [None] + bounds + [None]
    prev = None
    for i in range(n_batches):
        lo, hi = edges[i], edges[i + 1]
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (day > F.lit(lo))
        if hi is not None:
            cond = cond & (day <= F.lit(hi))
        part = df.filter(cond)
        out = part
        if redeliver_share and prev is not None:
            out = out.unionByName(prev.filter(F.pmod(F.xxhash64(*prev.columns), F.lit(redeliver_share)) == 0))
        out.repartition(files_per_batch).write.mode("append").parquet(path)
        prev = part


def _run(query_builder, checkpoint: str, trigger: dict | None, name: str,
         spark: SparkSession | None = None, state_partitions: int | None = None):
    """Start a stream; ``state_partitions`` fixes its shuffle/state partition
    count (kept in the checkpoint for the query's life).  The session conf is
    changed only while the query starts: the stream runs on a clone."""
    q = query_builder.option("checkpointLocation", checkpoint).queryName(name)
    q = q.trigger(**(trigger or {"availableNow": True}))
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key) if (spark is not None and state_partitions) else None
    try:
        if old is not None:
            spark.conf.set(key, str(state_partitions))
        q = q.start()
    finally:
        if old is not None:
            spark.conf.set(key, old)
    if (trigger or {}).get("availableNow", True):
        q.awaitTermination()
    return q


def stream_active_shipments(spark: SparkSession, src: str, state_path: str, checkpoint: str,
                            dim_port_b: DataFrame, as_of: dt.datetime, trigger: dict | None = None,
                            state_partitions: int | None = None, files_per_batch: int = 2):
    """M1: shipments are left-joined with the ports in the stream and logged per
    micro-batch; the live table is the latest row per shipment without ATA.  A later row
    with an ATA therefore removes the shipment."""
    from ..sources import schemas
    log = ChangelogTable(spark, state_path)
    stg = staging.stg_shipments(file_stream(spark, src, schemas.RAW_SHIPMENTS, files_per_batch))
    q = _run(live.with_destination(stg, dim_port_b).writeStream.foreachBatch(log.write_batch), checkpoint, trigger,
             "dt_active_shipments", spark, state_partitions)
    return q, (lambda: live.in_transit(latest_shipments(spark, state_path), as_of))


def latest_shipments(spark: SparkSession, state_path: str) -> DataFrame:
    """The latest row of every shipment that ``stream_active_shipments`` has logged, arrived
    ones included."""
    return ChangelogTable(spark, state_path).read_latest(["shipment_id"], ["_loaded_at"])


WINDOW_PANES, PANE_MINUTES = 96, 15     # 24 hours that slide by 15 minutes
PANE_KEYS = ["port_code", "pane"]
PANE_SUMS = ["vessels_in_port", "wait_sum", "wait_n", "congested_vessels", "late_calls"]


def pane_log(spark: SparkSession, state_path: str) -> PaneLog:
    """Sums per port and pane of ``stream_port_congestion``; all ports, known or not."""
    return PaneLog(spark, state_path, PANE_KEYS, PANE_SUMS)


def stream_port_congestion(spark: SparkSession, src: str, state_path: str, checkpoint: str,
                           dim_port_b: DataFrame, trigger: dict | None = None,
                           state_partitions: int | None = None, files_per_batch: int = 2):
    """M2: rolling 24 h window per port, sliding every 15 minutes, from 15-minute panes.
    A call is late when it arrived a whole window
    before the newest call of the earlier micro-batches."""
    from ..sources import schemas
    log = pane_log(spark, state_path)
    calls = staging.stg_vessel_calls(file_stream(spark, src, schemas.RAW_VESSEL_CALLS, files_per_batch))

    def sink(batch: DataFrame, batch_id: int) -> None:
        pane = pane_of(F.col("arrival_ts"), PANE_MINUTES)
        newest = log.newest("pane", batch_id)
        late = F.lit(False) if newest is None else F.col("pane") <= newest - WINDOW_PANES
        wait = F.col("anchorage_wait_h")
        panes = batch.withColumn("pane", pane).groupBy(*PANE_KEYS).agg(
            F.count(F.lit(1)).alias("vessels_in_port"), F.coalesce(F.sum(wait), F.lit(0)).cast("long").alias("wait_sum"),
            F.count(wait).alias("wait_n"), F.count(F.when(d.is_congested("anchorage_wait_h"), 1)).alias("congested_vessels"))
        log.write_batch(panes.withColumn("late_calls", F.when(late, F.col("vessels_in_port")).otherwise(0).cast("long")), batch_id)

    q = _run(calls.writeStream.foreachBatch(sink), checkpoint, trigger, "dt_port_congestion", spark, state_partitions)

    def windows() -> DataFrame:
        known = log.read_sums().join(dim_port_b.select("port_code"), "port_code", "left_semi")
        t = sliding_sums(known, ["port_code"], PANE_SUMS[:-1], WINDOW_PANES)
        t = t.join(dim_port_b.select("port_code", "port_name", "lat", "lon"), "port_code")
        return t.select(pane_start(F.col("window"), PANE_MINUTES).alias("window_start"),
                        pane_start(F.col("window") + WINDOW_PANES, PANE_MINUTES).alias("window_end"),
                        "port_code", "port_name", "lat", "lon", "vessels_in_port",
                        rnd(F.col("wait_sum") / F.nullif(F.col("wait_n"), F.lit(0)), 1).alias("avg_wait_hours"),
                        "congested_vessels",
                        pct_of(F.col("congested_vessels"), F.col("vessels_in_port")).alias("congestion_pct")) \
            .withColumn("congestion_level", d.congestion_level(F.col("congestion_pct")))
    return q, windows


def stream_fact_upsert(spark: SparkSession, src: str, state_path: str, checkpoint: str, wh,
                       trigger: dict | None = None, state_partitions: int | None = None, files_per_batch: int = 2):
    """M4: ``fct_shipment_events`` maintained per micro-batch (upsert by shipment_id,
    latest ``_loaded_at`` wins); equals the batch model.  Shipment and carrier keys come
    from the micro-batch's own rows: ids first seen by the stream have theirs."""
    from ..sources import schemas
    log = ChangelogTable(spark, state_path)
    raw = file_stream(spark, src, schemas.RAW_SHIPMENTS, files_per_batch)

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = facts.fct_shipment_events(staging.stg_shipments(batch), None, wh.dim_date, wh.dim_port_b, None)
        log.write_batch(rows, batch_id)

    q = _run(raw.writeStream.foreachBatch(sink), checkpoint, trigger, "fct_shipment_events_stream",
             spark, state_partitions)
    return q, (lambda: log.read_latest(["shipment_id"], ["_loaded_at"]))


def stream_dedup(spark: SparkSession, src: str, out_path: str, checkpoint: str,
                 trigger: dict | None = None, delay: str = "400 days", state_partitions: int | None = None,
                 files_per_batch: int = 2):
    """M6: duplicate deliveries dropped within the watermark; append sink.  Rows behind the
    watermark are dropped too; ``RefreshLog`` counts them."""
    from ..sources import schemas
    raw = file_stream(spark, src, schemas.RAW_SHIPMENTS, files_per_batch)
    dedup = (raw.withColumn("__event_ts", F.col("_loaded_at").cast("timestamp"))
             .withWatermark("__event_ts", delay).dropDuplicatesWithinWatermark(["shipment_id"])
             .drop("__event_ts"))
    q = _run(dedup.writeStream.format("parquet").option("path", out_path).outputMode("append"),
             checkpoint, trigger, "raw_shipments_dedup", spark, state_partitions)
    return q, (lambda: spark.read.parquet(out_path))
