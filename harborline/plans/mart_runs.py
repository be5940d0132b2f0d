"""Marts kept up to date by the keys that changed (survey A14, J14, J17, M5).

The facts are stored as snapshots; the difference of two snapshots gives the rows that
came, went or changed since the mart was built, whatever their dates.  Only the
(port, week) or (port, day) keys of these rows are modelled again, so late rows for a
past week count and the newest week does not stay partial.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.broadcast import checked_broadcast
from ..operators.incremental import PartitionedTable, VersionedTable, run_by_dirty_keys
from . import marts

ARRIVAL_MONTH, DEPARTURE_MONTH = "arrival_month", "etd_month"
DAY_KEYS = ["port_code", "report_date"]
ROLLING = 6     # earlier days in the rolling mean


def month_of(col: str | F.Column) -> F.Column:
    return (F.year(col) * 100 + F.month(col)).cast("int")


def _months(days: DataFrame, first: str, last: F.Column) -> list[int]:
    """The months that the days from ``first`` to ``last`` lie in: a calendar's at most."""
    both = days.select(month_of(first).alias("m")).union(days.select(month_of(last).alias("m")))
    return [r.m for r in both.distinct().collect() if r.m is not None]


def congestion_run(table: VersionedTable, dwell: PartitionedTable, events: PartitionedTable, dim_port_b: DataFrame,
                   full_refresh: bool = False, tag: str | None = None) -> int | None:
    """J17 by dirty (port, week) keys."""
    def dirty(name: str, rows: DataFrame) -> DataFrame:
        return (marts.dwell_weeks if name == "dwell" else marts.shipment_weeks)(rows, dim_port_b)

    def build(keys, rows, stored):
        fpd, fse = rows["dwell"], rows["events"]
        if keys is None:
            return None, marts.congestion_delay_impact(fpd.drop(ARRIVAL_MONTH), fse.drop(DEPARTURE_MONTH), dim_port_b)
        only = checked_broadcast(keys)
        months = _months(keys, "week_start_date", F.date_add("week_start_date", 6))
        weeks = keys.agg(F.min("week_start_date").alias("lo"), F.date_add(F.max("week_start_date"), 6).alias("hi")).first()
        fpd = fpd.filter(F.col(ARRIVAL_MONTH).isin(months))
        fse = fse.filter(F.col("eta_date_key").between(F.lit(weeks.lo or dt.date.min), F.lit(weeks.hi or dt.date.min)))
        return keys, marts.congestion_delay_impact(fpd, fse, dim_port_b, only=only)
    return run_by_dirty_keys(table, {"dwell": dwell, "events": events}, marts.WEEK_KEYS, dirty, build, full_refresh, tag)


def throughput_run(table: VersionedTable, dwell: PartitionedTable, dim_port_b: DataFrame, dim_date_b: DataFrame,
                   full_refresh: bool = False, tag: str | None = None) -> int | None:
    """J14 by dirty (port, day) keys.  A day's rolling mean runs over the port's last seven
    reported days, so a day that came, went or changed also touches the six reported
    after it; these are modelled again from the days their means need."""
    def daily(fpd: DataFrame) -> DataFrame:
        return marts.port_throughput_daily(fpd, dim_port_b, dim_date_b)

    def dirty(_: str, rows: DataFrame) -> DataFrame:
        return (rows.join(dim_port_b.select("port_key", "port_code"), "port_key")
                .select("port_code", F.col("arrival_date_key").alias("report_date")).filter("report_date IS NOT NULL"))

    def build(keys, rows, stored):
        if keys is None:
            return None, daily(rows["dwell"].drop(ARRIVAL_MONTH))
        calls = (rows["dwell"].join(dim_port_b.select("port_key", "port_code"), "port_key")
                 .withColumnRenamed("arrival_date_key", "report_date")
                 .join(dim_date_b.select(F.col("date_key").alias("report_date")), "report_date"))

        def calls_of(days: DataFrame) -> DataFrame:
            months = _months(days, "report_date", F.col("report_date"))
            return calls.filter(F.col(ARRIVAL_MONTH).isin(months)).join(checked_broadcast(days), DAY_KEYS, "left_semi")
        # the days of each changed port, old and new; a changed day may have no call any more
        left = calls_of(keys).select(*DAY_KEYS).distinct().withColumn("here", F.lit(1)).withColumn("changed", F.lit(1))
        gone = keys.join(left, DAY_KEYS, "left_anti").withColumn("here", F.lit(0)).withColumn("changed", F.lit(1))
        others = (stored.select(*DAY_KEYS).join(keys.select("port_code").distinct(), "port_code", "left_semi")
                  .join(keys, DAY_KEYS, "left_anti").withColumn("here", F.lit(1)).withColumn("changed", F.lit(0)))
        by_day = Window.partitionBy("port_code").orderBy("report_date").rowsBetween(Window.unboundedPreceding, 0)
        days = table.scratch(left.unionByName(gone).unionByName(others).withColumn("n", F.sum("here").over(by_day)), "days")
        after = days.filter("changed = 1").select(
            "port_code", F.explode(F.sequence(F.col("n") + 1 - F.col("here"), F.col("n") + ROLLING)).alias("n")).distinct()
        reported = days.filter("here = 1").select(*DAY_KEYS, "n")
        touched = reported.join(after, ["port_code", "n"], "left_semi")
        needed = touched.select("port_code", F.explode(F.sequence(F.col("n") - ROLLING, F.col("n"))).alias("n")).distinct()
        needed = reported.join(needed, ["port_code", "n"], "left_semi").select(*DAY_KEYS)
        replaced = table.scratch(touched.select(*DAY_KEYS).unionByName(keys).distinct(), "replaced")
        read = calls_of(needed).withColumnRenamed("report_date", "arrival_date_key").drop("port_code", ARRIVAL_MONTH)
        return replaced, daily(read).join(replaced, DAY_KEYS, "left_semi")
    return run_by_dirty_keys(table, {"dwell": dwell}, DAY_KEYS, dirty, build, full_refresh, tag)
