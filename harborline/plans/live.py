"""Batch twins of the two near-real-time tables (survey M1, M2, O1, O3).

The streaming versions live in ``harborline.streaming``; these are the same
results computed over the tables at rest, used by monitoring, dashboards and
as the reference the streams are tested against.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domain as d
from ..functions.scalars import hours_between, lit_ntz
from .marts import pct_of, rnd

ACTIVE_COLUMNS = ["shipment_id", "bl_number", "origin_port_code", "dest_port_code", "carrier_code",
                  "eta", "delay_hours", "delay_category", "dest_port_name", "dest_lat", "dest_lon",
                  "hours_to_eta"]


UNKNOWN_PORT = "UNKNOWN PORT"


def with_destination(stg_shipments: DataFrame, dim_port_b: DataFrame) -> DataFrame:
    """Staged shipments with their destination's name and place; a left join, also of
    a stream, so shipments to a port that the seed does not know stay, labelled."""
    p = dim_port_b.select(F.col("port_code").alias("dest_port_code"),
                          F.col("port_name").alias("dest_port_name"),
                          F.col("lat").alias("dest_lat"), F.col("lon").alias("dest_lon"), F.lit("KNOWN").alias("__known"))
    return (stg_shipments.join(p, "dest_port_code", "left")
            .withColumn("dest_port_status", F.coalesce("__known", F.lit(UNKNOWN_PORT))).drop("__known"))


def in_transit(located: DataFrame, as_of) -> DataFrame:
    """M1 of the latest located row per shipment: those that have not arrived."""
    return (located.filter(F.col("ata").isNull())
            .withColumn("hours_to_eta", hours_between(lit_ntz(as_of), F.col("eta"))).select(*ACTIVE_COLUMNS))


def active_shipments(latest_shipments: DataFrame, dim_port_b: DataFrame, as_of) -> DataFrame:
    """M1: shipments still in transit, given the latest row per id."""
    return in_transit(with_destination(latest_shipments, dim_port_b), as_of)


def unknown_ports(located: DataFrame) -> DataFrame:
    """Shipments per destination that the port seed does not know."""
    return (located.filter(F.col("dest_port_status") == UNKNOWN_PORT)
            .groupBy("dest_port_code", "dest_port_status").agg(F.count(F.lit(1)).alias("shipments")))


def congestion_window_end(calls: DataFrame):
    """The newest arrival: the 'now' of the call feed."""
    return calls.agg(F.max("arrival_ts").alias("t")).first()["t"]


def port_congestion_24h(calls: DataFrame, dim_port_b: DataFrame, window_end=None,
                        hours: int = 24) -> DataFrame:
    """M2: per port, calls that arrived in the ``hours`` before ``window_end``
    (default: the newest arrival), with wait, congestion share and level."""
    end = window_end if window_end is not None else congestion_window_end(calls)
    end_c = lit_ntz(end)
    start_c = end_c - F.make_dt_interval(F.lit(0), F.lit(hours))
    w = calls.filter((F.col("arrival_ts") > start_c) & (F.col("arrival_ts") <= end_c))
    p = dim_port_b.select("port_code", "port_name", "lat", "lon")
    cong = F.sum(F.when(d.is_congested("anchorage_wait_h"), 1).otherwise(0)).cast("long")
    g = (w.join(p, "port_code")
         .groupBy("port_code", "port_name", "lat", "lon")
         .agg(F.count(F.lit(1)).alias("vessels_in_port"),
              rnd(F.avg("anchorage_wait_h"), 1).alias("avg_wait_hours"),
              cong.alias("congested_vessels"),
              pct_of(cong, F.count(F.lit(1))).alias("congestion_pct")))
    return g.withColumn("congestion_level", d.congestion_level(F.col("congestion_pct")))
