"""Gold analytics marts (survey J13-J18).

Every aggregate is partial (map-side).  Marts with exact percentiles of an
integer measure (hours, days) aggregate in two levels: per (group, value),
then per group with the percentiles read from that histogram
(``operators.histogram``): one scan, code-generated hash aggregates, memory
bounded by distinct values.  The continuous landed cost uses the
value-range partitioned ``operators.percentile``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domain as d
from ..functions.scalars import count_if, haversine_km, safe_div, week_start
from ..operators.broadcast import checked_broadcast
from ..operators.files import file_count
from ..operators.histogram import COUNT, VALUE, histogram_aggregate, nonnull_count
from ..operators.percentile import exact_percentiles, null_safe_join
from ..operators.spatial import pairs_within


# Row bound under which the port seed (and tables derived from it) is broadcast.
SEED_ROWS = 100_000


def rnd(x: Column, n: int) -> Column:
    """Round a double half away from zero on its binary value.

    Spark's ``round`` on doubles goes through the shortest decimal string
    (1.005 -> 1.01); scaling first rounds the stored binary value (-> 1.0),
    the usual SQL-engine behaviour.  Decimals keep ``F.round``.
    """
    m = float(10 ** n)
    return F.round(x.cast("double") * m, 0) / m


def pct_of(part: Column, whole: Column, n: int = 1) -> Column:
    return rnd(safe_div(part.cast("double"), whole) * 100, n)


def dec_avg(x: Column) -> Column:
    """Average of a decimal as double: exact sum, one division."""
    return F.sum(x).cast("double") / F.count(x)


def pctl(x: Column, p: float, approx: bool = False) -> Column:
    """Continuous percentile (linear interpolation) as double, 1e-6 grain."""
    x = x.cast("double")
    v = F.percentile_approx(x, p, 10000) if approx else F.percentile(x, F.lit(p))
    return F.round(v, 6)


def _avg_v() -> Column:
    """Level-2 mean of the histogram measure: exact sums, one division."""
    return F.sum(F.col(VALUE) * F.col(COUNT)) / F.sum(nonnull_count())


def carrier_performance(fse: DataFrame, dim_carrier: DataFrame, latest_shipments: DataFrame,
                        dim_port_b: DataFrame) -> DataFrame:
    """KPIs per carrier x lane (two-level aggregation on delay hours).  A shipment's
    lane is that of its latest version (one row per id)."""
    c = dim_carrier.select("carrier_key", "carrier_code", "carrier_name", "alliance")
    # ``shipment_key = MD5(shipment_id)`` on both sides, so equal keys mean equal
    # ids: joining on the id keeps the partitioning of the fact's own join with
    # the shipment dimension (one shuffle of the shipments instead of two).
    sh = latest_shipments.select("shipment_id", "origin_port_code", "dest_port_code")
    p = dim_port_b.select(F.col("port_key").alias("dest_port_key"),
                          F.col("port_name").alias("dest_port_name"))
    s = (fse.filter(F.col("shipment_key").isNotNull())
         .select("carrier_key", "shipment_id", "dest_port_key", "delay_hours",
                 "delay_category", "declared_value_usd"))
    j = (s.join(sh, "shipment_id").join(c, "carrier_key")
         .join(p, "dest_port_key", "left"))
    keys = ["carrier_code", "carrier_name", "alliance", "origin_port_code", "dest_port_code",
            "dest_port_name"]
    cat, v, n = F.col("delay_category"), F.col(VALUE), F.col(COUNT)
    dh, val = F.col("delay_hours"), F.col("declared_value_usd")
    total = F.sum(n)
    out = histogram_aggregate(
        j, keys, dh, {"p50_delay_hours": 0.5, "p90_delay_hours": 0.9},
        level1={"on_time": count_if(cat == d.ON_TIME), "minor": count_if(cat == d.MINOR),
                "moderate": count_if(cat == d.MODERATE), "severe": count_if(cat == d.SEVERE),
                "s_dv": F.sum(dh * val), "s_val": F.sum(val)},
        level2={"total_shipments": total,
                "on_time_pct": pct_of(F.sum("on_time"), total),
                "minor_delay_count": F.sum("minor").cast("long"),
                "moderate_delay_count": F.sum("moderate").cast("long"),
                "severe_delay_count": F.sum("severe").cast("long"),
                "avg_delay_hours": rnd(_avg_v(), 1),
                "avg_delay_hours_when_late": rnd(F.sum(F.when(v > 0, v * n))
                                                 / F.sum(F.when(v > 0, n)), 1),
                "max_delay_hours": F.max(v).cast("long"),
                "value_weighted_delay_hours": rnd(F.sum("s_dv").cast("double")
                                                  / F.nullif(F.sum("s_val").cast("double"), F.lit(0.0)), 1)})
    return out.withColumn("origin_port_name", F.col("origin_port_code"))


def port_throughput_daily(fpd: DataFrame, dim_port_b: DataFrame, dim_date_b: DataFrame,
                          after_date=None, stored: DataFrame | None = None) -> DataFrame:
    """Daily KPIs per port plus a 7-row rolling mean of the daily mean.

    One scan: level 1 aggregates per (port, day, dwell value), level 2 per
    (port, day) with exact dwell percentiles from that histogram.  The window
    runs over the aggregated rows (one per port and day), so a partition
    holds at most one port's calendar, whatever the fact size.
    ``after_date`` is the incremental watermark (strict ``>``).  With it, the
    calls of each port's last six days in the ``stored`` mart are read again,
    so that the first new days' means run over the same seven rows as in a
    full refresh.
    """
    p = dim_port_b.select("port_key", "port_code", "port_name", "region", "port_type")
    dd = dim_date_b.select(F.col("date_key").alias("arrival_date_key"), "year_num",
                           "month_num", "week_num", "year_month")
    f = fpd.select("port_key", "arrival_date_key", "teu_count", "dwell_hours",
                   "anchorage_wait_h", "is_congested")
    j = f.join(p, "port_key").join(dd, "arrival_date_key")
    if after_date is not None:
        after = F.lit(after_date).cast("date")
        newest = Window.partitionBy("port_code").orderBy(F.col("report_date").desc())
        before = (stored.filter(F.col("report_date") <= after).withColumn("__n", F.row_number().over(newest))
                  .filter("__n <= 6").select("port_code", F.col("report_date").alias("arrival_date_key")))
        j = (j.filter(F.col("arrival_date_key") > after)
             .unionByName(j.filter(F.col("arrival_date_key") <= after)
                          .join(before, ["port_code", "arrival_date_key"], "left_semi").select(*j.columns)))
    keys = ["port_code", "port_name", "region", "port_type", "arrival_date_key",
            "year_num", "month_num", "week_num", "year_month"]
    v, n = F.col(VALUE), F.col(COUNT)
    g = histogram_aggregate(
        j, keys, F.col("dwell_hours"), {"p50_dwell_hours": 0.5, "p90_dwell_hours": 0.9},
        level1={"s_teu": F.sum("teu_count"), "n_teu": F.count("teu_count"),
                "s_wait": F.sum("anchorage_wait_h"), "n_wait": F.count("anchorage_wait_h"),
                "cong": count_if(F.col("is_congested"))},
        level2={"vessel_calls": F.sum(n),
                "total_teu": F.sum("s_teu").cast("long"),
                "avg_teu_per_call": rnd(F.sum("s_teu") / F.sum("n_teu"), 0),
                "__avg_dwell": _avg_v(),
                "min_dwell_hours": F.min(v).cast("long"),
                "max_dwell_hours": F.max(v).cast("long"),
                "avg_anchorage_wait_hours": rnd(F.sum("s_wait") / F.sum("n_wait"), 1),
                "congested_vessel_calls": F.sum("cong").cast("long"),
                "congestion_rate_pct": pct_of(F.sum("cong"), F.sum(n))})
    w = Window.partitionBy("port_code").orderBy("arrival_date_key").rowsBetween(-6, 0)
    out = (g.withColumn("rolling_7d_avg_dwell_hours", rnd(F.avg("__avg_dwell").over(w), 1))
           .withColumn("avg_dwell_hours", rnd(F.col("__avg_dwell"), 1))
           .withColumnRenamed("arrival_date_key", "report_date")
           .drop("__avg_dwell"))
    return out if after_date is None else out.filter(F.col("report_date") > after)


def customs_clearance_kpi(dim_customs: DataFrame, dim_port_b: DataFrame) -> DataFrame:
    """Clearance KPIs per port x entry type x payment mode (two-level
    aggregation on processing days: SLA flag and band are functions of it)."""
    p = dim_port_b.select("port_code", "port_name")
    b = (dim_customs.filter(F.col("entry_number").isNotNull())
         .select("port_code", "entry_type", "payment_mode", "processing_days",
                 "tariff_rate_pct", "total_tax_usd", "declared_value_usd")
         .join(p, "port_code", "left"))
    v, n = F.col(VALUE), F.col(COUNT)
    band = d.clearance_band(v)
    breach = F.sum(F.when(d.is_sla_breach(v), n).otherwise(0))
    total = F.sum(n)

    def band_count(name):
        return F.sum(F.when(band == name, n).otherwise(0)).cast("long")

    def avg_of(col):
        return rnd(F.sum(f"s_{col}").cast("double") / F.sum(f"n_{col}"), 2)
    level1 = {}
    for col in ["tariff_rate_pct", "total_tax_usd", "declared_value_usd"]:
        level1[f"s_{col}"] = F.sum(col)
        level1[f"n_{col}"] = F.count(col)
    return histogram_aggregate(
        b, ["port_code", "port_name", "entry_type", "payment_mode"], F.col("processing_days"),
        {"p50_processing_days": 0.5, "p90_processing_days": 0.9}, level1=level1,
        level2={"total_entries": total,
                "avg_processing_days": rnd(_avg_v(), 1),
                "min_processing_days": F.min(v).cast("int"),
                "max_processing_days": F.max(v).cast("int"),
                "sla_breach_count": breach.cast("long"),
                "sla_breach_pct": pct_of(breach, total),
                "fast_count": band_count("FAST"), "standard_count": band_count("STANDARD"),
                "slow_count": band_count("SLOW"), "critical_count": band_count("CRITICAL"),
                "avg_tariff_rate_pct": avg_of("tariff_rate_pct"),
                "avg_total_tax_usd": avg_of("total_tax_usd"),
                "total_tax_collected_usd": F.round(F.sum("s_total_tax_usd"), 2).cast("decimal(38,2)"),
                "avg_declared_value_usd": avg_of("declared_value_usd")})


def commodity_cost_summary(landed: DataFrame, latest_shipments: DataFrame, tariffs_b: DataFrame,
                           dim_port_b: DataFrame, approx: bool = False,
                           distributed_median: bool = True) -> DataFrame:
    """Landed-cost statistics per commodity x cargo type x destination.

    Landed cost is a continuous amount (nearly one distinct value per row),
    so its exact median is computed by ``exact_percentiles`` (value-range
    partitioned) instead of a per-group value map, then joined to the other
    aggregates on the group keys (both sides are one row per group)."""
    lc = landed.select("shipment_id", "dest_port_code", "cif_usd", "duty_rate_pct",
                       "duties_usd", "vat_usd", "total_landed_cost_php", "usd_php_rate")
    s = latest_shipments.select("shipment_id", "cargo_type", "commodity_code")
    t = tariffs_b.select("commodity_code", F.col("description").alias("commodity_desc"),
                         "atiga_rate_pct")
    p = dim_port_b.select(F.col("port_code").alias("dest_port_code"),
                          F.col("port_name").alias("dest_port_name"))
    cb = lc.join(s, "shipment_id").join(t, "commodity_code", "left").join(p, "dest_port_code", "left")
    cif, du, vat, tot = (F.col(c) for c in ("cif_usd", "duties_usd", "vat_usd", "total_landed_cost_php"))
    burden = safe_div((du + vat).cast("double"), (cif + du + vat).cast("double"))
    keys = ["commodity_code", "commodity_desc", "cargo_type", "dest_port_code", "dest_port_name"]
    median = [] if (distributed_median and not approx) else [pctl(tot, 0.5, approx).alias("p50_landed_cost_php")]
    g = (cb.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("shipment_count"),
                 rnd(dec_avg(cif), 2).alias("avg_cif_usd"),
                 rnd(dec_avg(du), 2).alias("avg_duties_usd"),
                 rnd(dec_avg(vat), 2).alias("avg_vat_usd"),
                 rnd(dec_avg(cif + du + vat), 2).alias("avg_total_tax_inclusive_usd"),
                 rnd(dec_avg(tot), 2).alias("avg_landed_cost_php"),
                 F.sum(tot).cast("decimal(38,2)").alias("total_landed_cost_php"),
                 F.min(tot).alias("min_landed_cost_php"),
                 F.max(tot).alias("max_landed_cost_php"),
                 *median,
                 rnd(dec_avg(F.col("duty_rate_pct")), 2).alias("avg_duty_rate_pct"),
                 F.max("atiga_rate_pct").alias("atiga_preferential_rate_pct"),
                 rnd(F.avg(burden) * 100, 1).alias("avg_tax_burden_pct"),
                 rnd(dec_avg(F.col("usd_php_rate")), 4).alias("avg_usd_php_rate")))
    if median:
        return g
    med = exact_percentiles(cb, keys, "total_landed_cost_php", {"p50_landed_cost_php": 0.5})
    return null_safe_join(g, med, keys, "left")


WEEK_KEYS = ["port_code", "week_start_date"]


def dwell_weeks(fpd: DataFrame, dim_port_b: DataFrame) -> DataFrame:
    p = dim_port_b.select("port_key", "port_code", "port_name")
    return fpd.join(p, "port_key").withColumn("week_start_date", week_start("arrival_date_key"))


def shipment_weeks(fse: DataFrame, dim_port_b: DataFrame) -> DataFrame:
    p = dim_port_b.select(F.col("port_key").alias("dest_port_key"), "port_code")
    return fse.join(p, "dest_port_key").withColumn("week_start_date", week_start("eta_date_key"))


def _of_keys(df: DataFrame, only: DataFrame | None, keys: list[str]) -> DataFrame:
    return df if only is None else df.join(only, keys, "left_semi")


def weekly_dwell(fpd: DataFrame, dim_port_b: DataFrame, only: DataFrame | None = None) -> DataFrame:
    j = _of_keys(dwell_weeks(fpd, dim_port_b), only, WEEK_KEYS)
    return (j.groupBy("port_code", "port_name", "week_start_date")
            .agg(F.count(F.lit(1)).alias("vessel_calls"),
                 rnd(F.avg("anchorage_wait_h"), 1).alias("avg_anchorage_wait_hours"),
                 rnd(F.avg("dwell_hours"), 1).alias("avg_dwell_hours"),
                 pct_of(count_if(F.col("is_congested")), F.count(F.lit(1))).alias("congestion_rate_pct"),
                 F.sum("teu_count").cast("long").alias("total_teu_handled")))


def weekly_shipments(fse: DataFrame, dim_port_b: DataFrame, only: DataFrame | None = None) -> DataFrame:
    j = _of_keys(shipment_weeks(fse, dim_port_b), only, WEEK_KEYS)
    cat = F.col("delay_category")
    return (j.groupBy("port_code", "week_start_date")
            .agg(F.count(F.lit(1)).alias("shipments_arriving"),
                 rnd(F.avg("delay_hours"), 1).alias("avg_shipment_delay_hours"),
                 pct_of(count_if(cat == d.ON_TIME), F.count(F.lit(1))).alias("on_time_rate_pct"),
                 count_if(cat == d.SEVERE).alias("severe_delay_count")))


def congestion_delay_impact(fpd: DataFrame, fse: DataFrame, dim_port_b: DataFrame,
                            after_week=None, only: DataFrame | None = None) -> DataFrame:
    """Weekly dwell and weekly arrivals per port, each aggregated before
    the (port, week) join so the join sees one row per key on each side.
    ``only`` (port_code, week_start_date) restricts both sides to these keys."""
    wd = weekly_dwell(fpd, dim_port_b, only)
    ws = weekly_shipments(fse, dim_port_b, only)
    j = wd.join(ws, WEEK_KEYS, "left")
    if after_week is not None:
        j = j.filter(F.col("week_start_date") > F.lit(after_week).cast("date"))
    return j.select("port_code", "port_name", "week_start_date", "vessel_calls",
                    "total_teu_handled", "avg_anchorage_wait_hours", "avg_dwell_hours",
                    "congestion_rate_pct", "shipments_arriving", "avg_shipment_delay_hours",
                    "on_time_rate_pct", "severe_delay_count",
                    d.congestion_level(F.col("congestion_rate_pct")).alias("congestion_level"),
                    rnd(safe_div(F.col("avg_shipment_delay_hours"),
                                 F.col("avg_anchorage_wait_hours")), 2).alias("delay_to_wait_ratio"))


def port_pairs(dim_port: DataFrame, radius_km: float = 200.0) -> DataFrame:
    """Ordered pairs of distinct ports within ``radius_km`` (grid-bucketed
    spatial join, then exact haversine refinement)."""
    pts = dim_port.select(F.col("port_key").alias("id"), "lat", "lon")
    pr = pairs_within(pts, "id", "lat", "lon", radius_km)
    names = dim_port.select(F.col("port_key").alias("id_b"), F.col("port_name").alias("alt_name"))
    return pr.join(checked_broadcast(names, SEED_ROWS), "id_b").select("id_a", "id_b", "distance_km", "alt_name")


def port_catchment_area(fse: DataFrame, dim_port: DataFrame, pairs_b: DataFrame) -> DataFrame:
    """Each moderately/severely delayed shipment x every other port
    within 200 km of its destination (every one, not only the nearest, as in
    the reference).  Facts are joined to the small pair table on an equality."""
    s = (fse.filter(F.col("delay_category").isin(d.MODERATE, d.SEVERE))
         .select("shipment_id", "dest_port_key"))
    p = dim_port.select(F.col("port_key").alias("dest_port_key"),
                        F.col("port_code").alias("dest_port_code"), "port_name")
    j = (s.join(checked_broadcast(p, SEED_ROWS), "dest_port_key")
         .join(pairs_b, F.col("dest_port_key") == F.col("id_a")))
    return j.select("shipment_id", "dest_port_code", "port_name", "distance_km",
                    F.col("alt_name").alias("nearest_alt_port"))


def by_distance(catchment: DataFrame) -> DataFrame:
    """The catchment rows as they are stored (H4): files in order of distance, each sorted
    by it.  There are only as many distances as port pairs, so the rows of one distance
    are dealt to many tasks by their shipment."""
    return (catchment.repartitionByRange(file_count(catchment, 4), "distance_km", "shipment_id")
            .sortWithinPartitions("distance_km"))


def port_distance(dim_port: DataFrame, radius_km: float = 200.0) -> DataFrame:
    """Pair table as a query: port codes, names and distance."""
    pts = dim_port.select(F.col("port_key").alias("id"), "lat", "lon")
    pr = pairs_within(pts, "id", "lat", "lon", radius_km)
    a = dim_port.select(F.col("port_key").alias("id_a"), F.col("port_code").alias("port_code"))
    b = dim_port.select(F.col("port_key").alias("id_b"), F.col("port_code").alias("alt_port_code"))
    return (pr.join(checked_broadcast(a, SEED_ROWS), "id_a").join(checked_broadcast(b, SEED_ROWS), "id_b")
            .select("port_code", "alt_port_code", "distance_km"))


__all__ = ["carrier_performance", "port_throughput_daily", "customs_clearance_kpi",
           "commodity_cost_summary", "congestion_delay_impact", "port_catchment_area",
           "port_pairs", "by_distance", "port_distance", "rnd", "pct_of", "dec_avg", "pctl", "haversine_km"]
