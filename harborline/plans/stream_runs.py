"""Streaming jobs as queries (survey E11, M1-M4, M6, L3).

Each call stages the bound bronze table as successive file batches in a
fresh folder under the shared checkpoint location, drains the stream with
``availableNow`` and returns the sink read back from storage.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import lit_ntz
from ..session import shared_dir
from ..streaming import live as sl
from ..streaming import refresh_log as rl
from . import live


def _parts(spark) -> int:
    """State partitions of the registered streams: one per core of the cluster."""
    return max(1, spark.sparkContext.defaultParallelism)


def _feed(df: DataFrame, src: str, **options) -> int:
    """Stage a feed in three batches of a file per core; returns the files per batch."""
    files = max(2, df.sparkSession.sparkContext.defaultParallelism)
    sl.stage_batches(df, src, "_loaded_at", files_per_batch=files, **options)
    return files


def _dirs(spark, name: str) -> tuple[str, str, str]:
    root = shared_dir(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")
    return f"{root}/source", f"{root}/sink", f"{root}/checkpoint"


def stream_active_shipments(wh) -> DataFrame:
    src, sink, ckpt = _dirs(wh.spark, "active_shipments")
    files = _feed(wh.raw_shipments, src)
    _, result = sl.stream_active_shipments(wh.spark, src, sink, ckpt, wh.dim_port_b, wh.as_of,
                                           state_partitions=_parts(wh.spark), files_per_batch=files)
    return result()


def stream_unknown_ports(wh) -> DataFrame:
    """The stream's shipments whose destination the port seed does not know."""
    src, sink, ckpt = _dirs(wh.spark, "unknown_ports")
    files = _feed(wh.raw_shipments, src)
    sl.stream_active_shipments(wh.spark, src, sink, ckpt, wh.dim_port_b, wh.as_of, state_partitions=_parts(wh.spark), files_per_batch=files)
    return live.unknown_ports(sl.latest_shipments(wh.spark, sink))


def stream_port_congestion(wh) -> DataFrame:
    src, sink, ckpt = _dirs(wh.spark, "port_congestion")
    files = _feed(wh.raw_vessel_calls, src)
    _, windows = sl.stream_port_congestion(wh.spark, src, sink, ckpt, wh.dim_port_b, state_partitions=_parts(wh.spark), files_per_batch=files)
    return windows()


LATE_EVERY = 50     # one call in so many comes with the last delivery


def _deliveries(raw: DataFrame) -> list[DataFrame]:
    """The calls by their load day: up to a day, up to another, and the rest with the late ones."""
    newest = raw.agg(F.max("_loaded_at")).first()[0]
    late = F.col("teu_count") % LATE_EVERY == 0
    cuts = [newest - dt.timedelta(days=20), newest - dt.timedelta(days=10), newest]
    first, second, third = (F.col("_loaded_at") <= lit_ntz(c) for c in cuts)
    return [raw.filter(first & ~late), raw.filter(second & ~first & ~late), raw.filter((third & ~second) | (second & late))]


def stream_late_calls(wh) -> DataFrame:
    """M2 with late rows: calls and late calls per port from the pane log.  The calls come
    in three deliveries, each drained by a stream that was started again."""
    src, sink, ckpt = _dirs(wh.spark, "late_calls")
    for delivery in _deliveries(wh.raw_vessel_calls):
        delivery.write.mode("append").parquet(src)
        sl.stream_port_congestion(wh.spark, src, sink, ckpt, wh.dim_port_b, files_per_batch=1_000_000)
    return (sl.pane_log(wh.spark, sink).read_sums().groupBy("port_code")
            .agg(F.sum("vessels_in_port").alias("calls"), F.sum("late_calls").alias("late_calls")))


def stream_fact_upsert(wh) -> DataFrame:
    src, sink, ckpt = _dirs(wh.spark, "fct_shipment_events")
    files = _feed(wh.raw_shipments, src)
    _, result = sl.stream_fact_upsert(wh.spark, src, sink, ckpt, wh, state_partitions=_parts(wh.spark), files_per_batch=files)
    return result()


def stream_dedup(wh) -> DataFrame:
    src, sink, ckpt = _dirs(wh.spark, "dedup")
    files = _feed(wh.raw_shipments, src, redeliver_share=5)
    _, result = sl.stream_dedup(wh.spark, src, sink, ckpt, state_partitions=_parts(wh.spark), files_per_batch=files)
    return result()


def stream_lag(wh) -> DataFrame:
    """L3 from the refresh log alone: both live tables are drained in three deliveries, each
    by a stream started again from its checkpoint with a listener of its own."""
    spark, log = wh.spark, shared_dir(wh.spark, f"streams/refresh_log-{uuid.uuid4().hex[:12]}")
    ships, calls = _dirs(spark, "lag_active"), _dirs(spark, "lag_congestion")
    day = F.dayofmonth("_loaded_at")
    for third in (day <= 10, (day > 10) & (day <= 20), day > 20):
        wh.raw_shipments.filter(third).write.mode("append").parquet(ships[0])
        wh.raw_vessel_calls.filter(third).write.mode("append").parquet(calls[0])
        with rl.RefreshLog(spark, log) as listener:
            for q, _ in (sl.stream_active_shipments(spark, *ships, wh.dim_port_b, wh.as_of, files_per_batch=1_000_000),
                          sl.stream_port_congestion(spark, *calls, wh.dim_port_b, files_per_batch=1_000_000)):
                listener.wait(q)
    lag = rl.refresh_lag(rl.read_log(spark, log), sl.TARGET_LAG, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    return lag.select("query_name", "batches", "input_rows", "late_rows_dropped", "target_lag_minutes", "lag_status")
