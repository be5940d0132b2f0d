"""Single-operator reports (each exposes one survey operator as a query)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import count_if, hours_between
from ..operators.asof import attach_daily_rate
from ..operators.histogram import COUNT, histogram_aggregate
from . import facts, marts, monitoring
from .marts import pctl, rnd


def fx_lookup(wh, mode: str) -> DataFrame:
    """D13 (``max_to_date``) / D14 (``asof``): the rate each shipment gets."""
    s = wh.stg_shipments.select("shipment_id", "eta")
    anchor = F.coalesce(F.to_date("eta"), F.lit(wh.as_of.date()))
    s = attach_daily_rate(s, anchor, wh.usd_php_rates, "rate_date", "usd_php_close", "usd_php_rate", mode)
    return s.select("shipment_id", F.to_date("eta").alias("eta_date"), "usd_php_rate")


def landed_cost_asof(wh) -> DataFrame:
    """J12 with the forward-filled FX rate (Z3 option)."""
    return facts.fct_landed_cost(wh.stg_shipments, wh.tariffs_b, wh.usd_php_rates, wh.as_of.date(), "asof")


def delay_bands(wh) -> DataFrame:
    """Band sizes with the raw (unclamped) hour range per band."""
    raw = hours_between("eta", "ata")
    return (wh.stg_shipments.groupBy("delay_category")
            .agg(F.count(F.lit(1)).alias("shipments"), F.min(raw).alias("min_raw_hours"),
                 F.max(raw).alias("max_raw_hours"), count_if(F.col("ata").isNull()).alias("in_transit"),
                 count_if(raw < 0).alias("early_arrivals")))


def join_inner_dim(wh) -> DataFrame:
    """Inner fact -> dimension join; unknown destinations drop out."""
    p = wh.dim_port_b.select(F.col("port_key").alias("dest_port_key"), "port_code", "port_name")
    return (wh.fct_shipment_events.join(p, "dest_port_key").groupBy("port_code", "port_name")
            .agg(F.count(F.lit(1)).alias("shipments"), F.count_distinct("carrier_key").alias("carriers")))


def percentiles(wh, approx: bool = False) -> DataFrame:
    """exact (or approximate) continuous percentiles of dwell and wait per port.

    Exact: two histogram aggregations (one per measure) joined on the port;
    approximate: ``percentile_approx`` sketches."""
    p = wh.dim_port_b.select("port_key", "port_code")
    f = wh.fct_port_dwell.join(p, "port_key")
    if not approx:
        dwell = histogram_aggregate(f, ["port_code"], F.col("dwell_hours"),
                                    {"p50_dwell_hours": 0.5, "p90_dwell_hours": 0.9}, {},
                                    {"calls": F.sum(COUNT)})
        wait = histogram_aggregate(f, ["port_code"], F.col("anchorage_wait_h"),
                                   {"p50_wait_hours": 0.5, "p90_wait_hours": 0.9}, {}, {})
        return dwell.join(wait, "port_code")
    return (f.groupBy("port_code")
            .agg(F.count(F.lit(1)).alias("calls"),
                 pctl(F.col("dwell_hours"), 0.5, approx).alias("p50_dwell_hours"),
                 pctl(F.col("dwell_hours"), 0.9, approx).alias("p90_dwell_hours"),
                 pctl(F.col("anchorage_wait_h"), 0.5, approx).alias("p50_wait_hours"),
                 pctl(F.col("anchorage_wait_h"), 0.9, approx).alias("p90_wait_hours")))


def rolling_7d_dwell(wh) -> DataFrame:
    """The 7-row rolling mean of daily mean dwell, per port."""
    return wh.port_throughput_daily.select("port_code", "report_date", "vessel_calls", "avg_dwell_hours",
                                           "rolling_7d_avg_dwell_hours")


def weekly_bucket(wh) -> DataFrame:
    """group by an expression (ISO week start) per port."""
    return marts.weekly_dwell(wh.fct_port_dwell, wh.dim_port_b)


def geo_cell_heatmap(wh) -> DataFrame:
    """C30 re-aimed: calls binned by the port's grid cell (resolution 5)."""
    f = wh.fct_port_dwell.filter(F.col("port_cell_res5").isNotNull())
    return (f.groupBy(F.col("port_cell_res5").alias("cell_id"))
            .agg(F.count(F.lit(1)).alias("vessel_calls"), F.sum("teu_count").cast("long").alias("total_teu"),
                 rnd(F.avg("dwell_hours"), 1).alias("avg_dwell_hours"),
                 count_if(F.col("is_congested")).alias("congested_calls")))


def customs_tax_recompute(wh) -> DataFrame:
    """Recompute duties, VAT on (value + duties) and total; list mismatches."""
    v, r = F.col("declared_value_usd"), F.col("tariff_rate_pct")
    exp_du = F.round(v * r * F.expr("0.01"), 2).cast("decimal(17,2)")
    c = wh.stg_customs_entries.withColumn("expected_duties_usd", exp_du)
    c = c.withColumn("expected_vat_usd",
                     F.round((v + F.col("expected_duties_usd")) * F.expr("0.12"), 2).cast("decimal(17,2)"))
    c = c.withColumn("expected_total_tax_usd",
                     (F.col("expected_duties_usd") + F.col("expected_vat_usd")).cast("decimal(17,2)"))
    du_bad = F.col("duties_usd") != F.col("expected_duties_usd")
    vat_bad = F.col("vat_usd") != F.col("expected_vat_usd")
    tot_bad = F.col("total_tax_usd") != F.col("expected_total_tax_usd")
    return (c.filter(du_bad | vat_bad | tot_bad)
            .select("entry_number", "shipment_id", "declared_value_usd", "tariff_rate_pct", "duties_usd",
                    "vat_usd", "total_tax_usd", "expected_duties_usd", "expected_vat_usd",
                    "expected_total_tax_usd", du_bad.alias("duties_mismatch"), vat_bad.alias("vat_mismatch"),
                    tot_bad.alias("total_mismatch")))


def union_checks(wh) -> DataFrame:
    """UNION ALL of the range, accepted-value and orphan check reports."""
    return (monitoring.range_checks(wh).select(F.lit("range").alias("check_kind"), "*")
            .unionByName(monitoring.accepted_value_violations(wh)
                         .select(F.lit("accepted_values").alias("check_kind"), "*"))
            .unionByName(monitoring.orphans(wh).select(F.lit("orphans").alias("check_kind"), "check_name",
                                                       F.col("orphan_count").alias("violation_count"))))
