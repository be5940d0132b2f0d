"""Durable log of the streams' refreshes (survey L3, L24, M3).

``RefreshLog`` is a streaming listener: after every micro-batch it appends one
Parquet row (query, batch, time, rows read, rows dropped as too late, rows kept
in state, milliseconds) under ``<path>/query_id=<id>``.  The id is kept in the
stream's checkpoint, so the rows of a restarted stream join those of its earlier
runs, and the lag report needs nothing but the log.  Listener calls of one driver
come one after the other and a stream runs in one driver, so no two writers
share a folder.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.files import path_exists
from ..operators.latest import latest_per_key

LOG_SCHEMA = ("query_name string, run_id string, batch_id long, refreshed_at string, input_rows long, "
              "late_rows_dropped long, state_rows long, duration_ms long")


class RefreshLog(StreamingQueryListener):
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> RefreshLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (p.name, str(p.runId), p.batchId, p.timestamp.rstrip("Z"), p.numInputRows,
               sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
               sum(s.numRowsTotal for s in p.stateOperators), p.durationMs.get("triggerExecution"))
        (self.spark.createDataFrame([row], LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{self.path}/query_id={p.id}"))

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, query, timeout: float = 60.0) -> None:
        """Until the rows of a stream that has ended are written: its end is reported
        after its batches."""
        if not self._end(query.runId).wait(timeout):
            raise TimeoutError(f"no end of stream {query.name} reported within {timeout} s")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch; a batch that was run again counts once, by its last report."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{LOG_SCHEMA}, query_id string")
    log = spark.read.schema(f"{LOG_SCHEMA}, query_id string").parquet(path)
    return latest_per_key(log, ["query_id", "batch_id"], ["refreshed_at"])


def refresh_lag(log: DataFrame, target_minutes: dict[str, float], now: dt.datetime) -> DataFrame:
    """L3: minutes since each live table's last refresh against three times its target
    lag.  A table that never reported is LAGGING."""
    seen = log.groupBy("query_name").agg(
        F.count(F.when(F.col("input_rows") > 0, 1)).alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows_dropped").alias("late_rows_dropped"),
        F.max(F.to_timestamp_ntz("refreshed_at")).alias("last_refresh"))
    spark = log.sparkSession
    targets = spark.createDataFrame(sorted(target_minutes.items()), "query_name string, target_lag_minutes double")
    waited = F.timestamp_diff("MINUTE", F.col("last_refresh"), F.lit(now.isoformat(" ")).cast("timestamp_ntz"))
    zero = F.lit(0).cast("long")
    return (targets.join(seen, "query_name", "left")
            .select("query_name", *[F.coalesce(c, zero).alias(c) for c in ("batches", "input_rows", "late_rows_dropped")],
                    "last_refresh", waited.alias("minutes_since_refresh"), "target_lag_minutes",
                    F.when(waited <= 3 * F.col("target_lag_minutes"), "OK").otherwise("LAGGING").alias("lag_status")))


def refresh_cost(log: DataFrame) -> DataFrame:
    """Refreshes, rows and seconds per live table and day."""
    return (log.groupBy("query_name", F.to_date(F.to_timestamp_ntz("refreshed_at")).alias("refresh_date"))
            .agg(F.count(F.lit(1)).alias("refreshes"), F.sum("input_rows").alias("input_rows"),
                 (F.sum("duration_ms") / 1000).alias("refresh_seconds")))
