"""Monitoring and sanity queries (survey 2.L), dashboards (2.O) and the
remaining single-purpose reports.  Each function takes a ``Warehouse`` and
returns a DataFrame; several checks on one table share one aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import domain as d
from ..functions.scalars import count_if, hours_between, lit_ntz, safe_div
from ..operators.allocation import share_out
from ..operators.latest import latest_per_key
from ..operators.checks import anti_join_count, count_checks, duplicate_count, null_rate_checks
from .marts import dec_avg, pct_of, rnd

# FIXED VALUES — accepted lists used by the monitoring checks (narrower than
# the declared tests, Z12) and the freshness limits.
MON_CARGO = ["FCL", "LCL", "RORO", "BULK"]
MON_ENTRY_TYPES = ["FORMAL", "INFORMAL", "WAREHOUSING"]
MON_PAYMENT_MODES = ["CASH", "SURETY_BOND", "DEFERRED"]
STALE_H, CRITICAL_H = 5, 8


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def _as_of(wh):
    return lit_ntz(wh.as_of)


def _as_of_date(wh):
    return F.lit(wh.as_of.date()).cast("date")


def bronze_freshness(wh, strict_reference: bool = False) -> DataFrame:
    """L1: newest load per bronze table; CRITICAL tested before STALE."""
    out = []
    for name, df in [("bronze.raw_vessel_calls", wh.raw_vessel_calls),
                     ("bronze.raw_shipments", wh.raw_shipments),
                     ("bronze.raw_customs_entries", wh.raw_customs_entries)]:
        g = df.agg(F.max("_loaded_at").alias("latest_load_ts"))
        h = hours_between(F.col("latest_load_ts"), _as_of(wh))
        if strict_reference:
            status = F.when(h > STALE_H, "STALE").when(h > CRITICAL_H, "CRITICAL").otherwise("OK")
        else:
            status = F.when(h > CRITICAL_H, "CRITICAL").when(h > STALE_H, "STALE").otherwise("OK")
        out.append(g.select(F.lit(name).alias("table_name"), "latest_load_ts",
                            h.alias("hours_since_load"), status.alias("freshness_status")))
    return _union(out)


def fact_freshness(wh) -> DataFrame:
    """L2: newest load per gold fact."""
    out = []
    for name, df in [("gold.fct_port_dwell", wh.fct_port_dwell),
                     ("gold.fct_shipment_events", wh.fct_shipment_events),
                     ("gold.fct_landed_cost", wh.fct_landed_cost)]:
        g = df.agg(F.max("_loaded_at").alias("latest_load_ts"))
        out.append(g.select(F.lit(name).alias("table_name"), "latest_load_ts",
                            hours_between(F.col("latest_load_ts"), _as_of(wh)).alias("hours_since_load")))
    return _union(out)


def layer_tables(wh) -> list[tuple[str, DataFrame]]:
    return [("bronze.raw_vessel_calls", wh.raw_vessel_calls),
            ("bronze.raw_shipments", wh.raw_shipments),
            ("bronze.raw_customs_entries", wh.raw_customs_entries),
            ("silver.stg_vessel_calls", wh.stg_vessel_calls),
            ("silver.stg_shipments", wh.stg_shipments),
            ("silver.stg_customs_entries", wh.stg_customs_entries),
            ("gold.dim_port", wh.dim_port), ("gold.dim_vessel", wh.dim_vessel),
            ("gold.dim_carrier", wh.dim_carrier), ("gold.dim_shipment", wh.dim_shipment),
            ("gold.dim_customs_entry", wh.dim_customs_entry),
            ("gold.fct_port_dwell", wh.fct_port_dwell),
            ("gold.fct_shipment_events", wh.fct_shipment_events),
            ("gold.fct_landed_cost", wh.fct_landed_cost),
            ("gold.carrier_performance", wh.carrier_performance),
            ("gold.port_throughput_daily", wh.port_throughput_daily),
            ("gold.customs_clearance_kpi", wh.customs_clearance_kpi),
            ("gold.commodity_cost_summary", wh.commodity_cost_summary),
            ("gold.congestion_delay_impact", wh.congestion_delay_impact),
            ("gold.port_catchment_area", wh.port_catchment_area),
            ("realtime.dt_active_shipments", wh.active_shipments),
            ("realtime.dt_port_congestion", wh.port_congestion_24h)]


def row_counts(wh) -> DataFrame:
    """L4: rows per table across all layers."""
    return _union([df.agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(n).alias("table_name"), "row_count") for n, df in layer_tables(wh)])


def _count(df, name):
    return df.agg(F.count(F.lit(1)).alias(name))


def layer_retention(wh) -> DataFrame:
    """Pass-through ratios between layers, one row.

    The nine counts are one-row aggregates folded into one row (no join)."""
    counts = [("bronze_vessel", wh.raw_vessel_calls), ("bronze_shipments", wh.raw_shipments),
              ("bronze_customs", wh.raw_customs_entries), ("silver_vessel", wh.stg_vessel_calls),
              ("silver_shipments", wh.stg_shipments), ("silver_customs", wh.stg_customs_entries),
              ("gold_dwell", wh.fct_port_dwell), ("gold_shipments", wh.fct_shipment_events),
              ("gold_landed", wh.fct_landed_cost)]
    row = side_by_side([_count(df, n) for n, df in counts])

    def ratio(a, b):
        return rnd(safe_div(F.col(a).cast("double"), F.col(b)) * 100, 2)
    return row.select(ratio("silver_vessel", "bronze_vessel").alias("vessel_bronze_to_silver_pct"),
                      ratio("silver_shipments", "bronze_shipments").alias("shipment_bronze_to_silver_pct"),
                      ratio("silver_customs", "bronze_customs").alias("customs_bronze_to_silver_pct"),
                      ratio("gold_dwell", "silver_vessel").alias("vessel_silver_to_gold_pct"),
                      ratio("gold_shipments", "silver_shipments").alias("shipment_silver_to_gold_pct"),
                      ratio("gold_landed", "silver_shipments").alias("landed_silver_to_gold_pct"))


def side_by_side(rows: list[DataFrame]) -> DataFrame:
    """Combine one-row aggregates into one row without a join: each frame is
    widened with typed NULLs for the others' columns, the frames are unioned
    and one ``max`` per column (NULLs ignored) folds them into a single row."""
    fields = [f for r in rows for f in r.schema.fields]
    widened = []
    for r in rows:
        own = set(r.columns)
        widened.append(r.select(*[F.col(f.name) if f.name in own
                                  else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]))
    u = reduce(lambda a, b: a.unionByName(b), widened)
    return u.agg(*[F.max(f.name).alias(f.name) for f in fields])


def daily_load_volume(wh, days: int = 14) -> DataFrame:
    """Rows loaded per day over the last ``days`` days (two tables)."""
    since = F.date_sub(_as_of_date(wh), days).cast("timestamp_ntz")
    out = []
    for name, df in [("bronze.raw_vessel_calls", wh.raw_vessel_calls),
                     ("bronze.raw_shipments", wh.raw_shipments)]:
        out.append(df.filter(F.col("_loaded_at") >= since)
                   .groupBy(F.to_date("_loaded_at").alias("load_date"))
                   .agg(F.count(F.lit(1)).alias("rows_loaded"))
                   .select(F.lit(name).alias("table_name"), "load_date", "rows_loaded"))
    return _union(out)


def null_rates(wh) -> DataFrame:
    """Null share of critical bronze columns, one aggregate per table."""
    return _union([
        null_rate_checks(wh.raw_vessel_calls, [("raw_vessel_calls.vessel_imo", "vessel_imo"),
                                               ("raw_vessel_calls.arrival_ts", "arrival_ts")]),
        null_rate_checks(wh.raw_shipments, [("raw_shipments.shipment_id", "shipment_id"),
                                            ("raw_shipments.eta", "eta")]),
        null_rate_checks(wh.raw_customs_entries, [("raw_customs_entries.entry_number", "entry_number"),
                                                  ("raw_customs_entries.shipment_id", "shipment_id")])])


def duplicate_keys(wh) -> DataFrame:
    """COUNT(*) - COUNT(DISTINCT key) for six tables."""
    checks = [("raw_shipments.shipment_id duplicates", wh.raw_shipments, "shipment_id"),
              ("raw_customs_entries.entry_number duplicates", wh.raw_customs_entries, "entry_number"),
              ("gold.fct_shipment_events.shipment_id duplicates", wh.fct_shipment_events, "shipment_id"),
              ("gold.fct_landed_cost.shipment_id duplicates", wh.fct_landed_cost, "shipment_id"),
              ("gold.dim_port.port_code duplicates", wh.dim_port, "port_code"),
              ("gold.dim_vessel.vessel_imo duplicates", wh.dim_vessel, "vessel_imo")]
    return _union([df.agg(duplicate_count(df, c).alias("duplicate_count"))
                   .select(F.lit(n).alias("check_name"), "duplicate_count") for n, df, c in checks])


def range_checks(wh) -> DataFrame:
    """Out-of-range rows; all checks of one table in one pass."""
    c = F.col
    return _union([
        count_checks(wh.fct_port_dwell, [
            ("fct_port_dwell: negative dwell_hours", c("dwell_hours") < 0),
            ("fct_port_dwell: zero dwell_hours", c("dwell_hours") == 0),
            ("fct_port_dwell: anchorage_wait_h > dwell_hours (impossible)",
             c("anchorage_wait_h") > c("dwell_hours"))]),
        count_checks(wh.fct_shipment_events, [
            ("fct_shipment_events: negative delay_hours", c("delay_hours") < 0),
            ("fct_shipment_events: ATA before ETA but delay_hours > 0",
             (c("ata") < c("eta")) & (c("delay_hours") > 0))]),
        count_checks(wh.fct_landed_cost, [
            ("fct_landed_cost: total_landed_cost_php <= 0", c("total_landed_cost_php") <= 0),
            ("fct_landed_cost: duties_usd > cif_usd (duty rate > 100%)", c("duties_usd") > c("cif_usd"))]),
        count_checks(wh.dim_customs_entry, [
            ("dim_customs_entry: negative processing_days", c("processing_days") < 0),
            ("dim_customs_entry: release_date before lodge_date", c("release_date") < c("lodge_date"))])])


def accepted_value_violations(wh) -> DataFrame:
    """Rows outside the monitoring lists (NULL is not a violation)."""
    c = F.col
    return _union([
        count_checks(wh.stg_vessel_calls, [("stg_vessel_calls: invalid cargo_type",
                                             ~c("cargo_type").isin(*MON_CARGO))]),
        count_checks(wh.stg_shipments, [("stg_shipments: invalid delay_category",
                                          ~c("delay_category").isin(*d.DELAY_CATEGORIES))]),
        count_checks(wh.stg_customs_entries, [
            ("stg_customs_entries: invalid entry_type", ~c("entry_type").isin(*MON_ENTRY_TYPES)),
            ("stg_customs_entries: invalid payment_mode", ~c("payment_mode").isin(*MON_PAYMENT_MODES))]),
        count_checks(wh.congestion_delay_impact, [("congestion_delay_impact: invalid congestion_level",
                                                    ~c("congestion_level").isin(*d.CONGESTION_LEVELS))])])


def orphans(wh) -> DataFrame:
    """Child rows without a parent (anti joins)."""
    checks = [("fct_shipment_events → dim_shipment orphans", wh.fct_shipment_events, wh.dim_shipment,
               "shipment_key", "shipment_key"),
              ("fct_port_dwell → dim_port orphans", wh.fct_port_dwell, wh.dim_port, "port_key", "port_key"),
              ("fct_port_dwell → dim_vessel orphans", wh.fct_port_dwell, wh.dim_vessel,
               "vessel_key", "vessel_key"),
              ("fct_landed_cost → dim_shipment orphans", wh.fct_landed_cost, wh.dim_shipment,
               "shipment_id", "shipment_id"),
              ("stg_customs_entries → stg_shipments FK orphans", wh.stg_customs_entries, wh.stg_shipments,
               "shipment_id", "shipment_id")]
    return _union([anti_join_count(ch.select(F.col(ck).alias("__ck")), pa, "__ck", pk)
                   .select(F.lit(n).alias("check_name"), "orphan_count")
                   for n, ch, pa, ck, pk in checks])


def tariff_coverage(wh) -> DataFrame:
    """Commodity codes of shipments without a tariff row."""
    t = wh.tariffs_b.select("commodity_code")
    return (wh.stg_shipments.join(t, "commodity_code", "left_anti")
            .groupBy("commodity_code").agg(F.count(F.lit(1)).alias("shipment_count"))
            .withColumn("note", F.lit("no tariff rate match — duty defaults to 0%")))


def fx_coverage(wh) -> DataFrame:
    """Shipments whose ETA precedes the first FX rate."""
    first = wh.usd_php_rates.agg(F.min("rate_date").alias("d")).first()["d"]
    s = wh.stg_shipments.filter(F.to_date("eta") < F.lit(first))
    return s.agg(F.count(F.lit(1)).alias("shipments_missing_fx_rate"),
                 F.min(F.to_date("eta")).alias("earliest_eta"),
                 F.lit(first).cast("date").alias("earliest_fx_date"))


def delay_distribution(wh) -> DataFrame:
    """Share of each delay band.  The window runs over the (four)
    aggregated rows, not over the facts."""
    g = wh.fct_shipment_events.groupBy("delay_category").agg(F.count(F.lit(1)).alias("shipment_count"))
    tot = F.sum("shipment_count").over(Window.partitionBy())
    return g.withColumn("pct_of_total", rnd(F.col("shipment_count") / tot * 100, 1))


def port_congestion_rate(wh) -> DataFrame:
    """Congestion share, dwell and wait per port."""
    p = wh.dim_port_b.select("port_key", "port_code", "port_name")
    f = wh.fct_port_dwell.join(p, "port_key")
    cong = count_if(F.col("is_congested"))
    return (f.groupBy("port_code", "port_name")
            .agg(F.count(F.lit(1)).alias("total_calls"), cong.alias("congested_calls"),
                 pct_of(cong, F.count(F.lit(1))).alias("congestion_rate_pct"),
                 rnd(F.avg("dwell_hours"), 1).alias("avg_dwell_hours"),
                 rnd(F.avg("anchorage_wait_h"), 1).alias("avg_anchorage_wait_hours")))


def carrier_on_time(wh) -> DataFrame:
    """On-time share and mean delay per carrier."""
    c = wh.dim_carrier.select("carrier_key", "carrier_code", "carrier_name", "alliance")
    f = wh.fct_shipment_events.join(c, "carrier_key")
    return (f.groupBy("carrier_code", "carrier_name", "alliance")
            .agg(F.count(F.lit(1)).alias("total_shipments"),
                 pct_of(count_if(F.col("delay_category") == d.ON_TIME), F.count(F.lit(1))).alias("on_time_pct"),
                 rnd(F.avg("delay_hours"), 1).alias("avg_delay_hours")))


def cost_by_cargo_type(wh) -> DataFrame:
    """Landed cost statistics per cargo type."""
    s = wh.latest_shipments.select("shipment_id", "cargo_type")
    f = wh.fct_landed_cost.join(s, "shipment_id")
    return (f.groupBy("cargo_type")
            .agg(F.count(F.lit(1)).alias("shipment_count"),
                 rnd(dec_avg(F.col("cif_usd")), 2).alias("avg_cif_usd"),
                 rnd(dec_avg(F.col("duty_rate_pct")), 2).alias("avg_duty_rate_pct"),
                 rnd(dec_avg(F.col("total_landed_cost_php")), 2).alias("avg_landed_cost_php"),
                 rnd(dec_avg(F.col("usd_php_rate")), 4).alias("avg_fx_rate")))


def customs_time_by_type(wh) -> DataFrame:
    """Processing time per entry type x payment mode."""
    p = F.col("processing_days")
    return (wh.dim_customs_entry.groupBy("entry_type", "payment_mode")
            .agg(F.count(F.lit(1)).alias("entry_count"),
                 rnd(F.avg(p), 1).alias("avg_processing_days"),
                 F.min(p).alias("min_processing_days"), F.max(p).alias("max_processing_days"),
                 count_if(p > 5).alias("sla_breach_count")))


def rt_sanity(wh) -> DataFrame:
    """Labelled counts over the two live tables."""
    a, c = wh.active_shipments, wh.port_congestion_24h
    return _union([
        count_checks(a, [("dt_active_shipments row count", F.lit(True)),
                         ("dt_active_shipments: severe delays", F.col("delay_category") == d.SEVERE)],
                     "value"),
        count_checks(c, [("dt_port_congestion row count", F.lit(True)),
                         ("dt_port_congestion: CRITICAL ports", F.col("congestion_level") == "CRITICAL")],
                     "value")])


def usage_daily(wh, days: int = 30, group: str | None = None) -> DataFrame:
    """Usage per day and group over the last ``days`` days."""
    m = wh.bronze.metering.filter(F.col("start_time") >= F.date_sub(_as_of_date(wh), days).cast("timestamp_ntz"))
    if group:
        m = m.filter(F.col("group_name") == group)
    return (m.groupBy(F.to_date("start_time").alias("usage_date"), "group_name")
            .agg(F.round(F.sum("credits_used"), 4).alias("credits_used"),
                 F.count(F.lit(1)).alias("query_count")))


def _recent_queries(wh, days: int):
    q = wh.bronze.queries
    return q.filter(F.col("start_time") >= F.date_sub(_as_of_date(wh), days).cast("timestamp_ntz"))


def slow_query_topk(wh, days: int = 7, min_ms: int = 30000, k: int = 20) -> DataFrame:
    """The ``k`` slowest queries above ``min_ms`` (top-k, unique tie-break)."""
    q = _recent_queries(wh, days).filter(F.col("total_elapsed_ms") > min_ms)
    return (q.orderBy(F.col("total_elapsed_ms").desc(), F.col("query_id").asc()).limit(k)
            .select("query_id", "query_text", "group_name",
                    rnd(F.col("total_elapsed_ms") / 1000, 1).alias("elapsed_seconds"),
                    rnd(F.col("compilation_ms") / 1000, 1).alias("compile_seconds"),
                    rnd(F.col("execution_ms") / 1000, 1).alias("execute_seconds"),
                    "bytes_scanned", "rows_produced", "start_time"))


def scan_ratio_topk(wh, days: int = 7, ratio: float = 0.9, k: int = 20) -> DataFrame:
    """Queries scanning more than ``ratio`` of partitions, top ``k`` by bytes."""
    share = safe_div(F.col("partitions_scanned").cast("double"), F.col("partitions_total"))
    q = _recent_queries(wh, days).filter((F.col("partitions_total") > 0) & (share > ratio))
    return (q.orderBy(F.col("bytes_scanned").desc(), F.col("query_id").asc()).limit(k)
            .select("query_id", F.substring("query_text", 1, 120).alias("query_preview"),
                    "bytes_scanned", "partitions_scanned", "partitions_total",
                    rnd(share * 100, 1).alias("pct_partitions_scanned"), "start_time"))


def active_idle_ratio(wh, days: int = 7) -> DataFrame:
    """Active vs idle metering intervals per group."""
    m = wh.bronze.metering.filter(F.col("start_time") >= F.date_sub(_as_of_date(wh), days).cast("timestamp_ntz"))
    act = count_if(F.col("credits_used") > 0)
    return (m.groupBy("group_name")
            .agg(act.alias("active_intervals"), count_if(F.col("credits_used") == 0).alias("idle_intervals"),
                 pct_of(act, F.count(F.lit(1))).alias("active_pct"),
                 F.round(F.sum("credits_used"), 4).alias("total_credits")))


def refresh_usage(wh, days: int = 30) -> DataFrame:
    """Refresh cost per live table and day."""
    r = wh.bronze.refreshes.filter(F.col("start_time") >= F.date_sub(_as_of_date(wh), days).cast("timestamp_ntz"))
    return (r.groupBy("table_name", F.to_date("start_time").alias("usage_date"))
            .agg(F.round(F.sum("credits_used"), 6).alias("credits_used"),
                 F.count(F.lit(1)).alias("refresh_count")))


def health_summary(wh) -> DataFrame:
    """Executive one-row status: freshness, volumes, DQ counts."""
    fresh = wh.raw_shipments.agg(F.max("_loaded_at").alias("latest_bronze_ts"))
    f = wh.fct_shipment_events
    dq = f.agg(count_if(F.col("shipment_id").isNull()).alias("null_shipment_ids"),
               duplicate_count(f, "shipment_id").alias("dup_shipment_ids"),
               count_if(F.col("delay_hours") < 0).alias("negative_delays"))
    row = side_by_side([fresh, _count(wh.raw_shipments, "bronze_rows"), _count(wh.stg_shipments, "silver_rows"),
                        _count(f, "gold_rows"), _count(wh.active_shipments, "realtime_rows"), dq])
    h = hours_between(F.col("latest_bronze_ts"), _as_of(wh))
    bad = (F.col("null_shipment_ids") > 0) | (F.col("dup_shipment_ids") > 0) | (F.col("negative_delays") > 0)
    return row.select("latest_bronze_ts", h.alias("hours_since_bronze_load"),
                      F.when(h > STALE_H, "STALE").otherwise("OK").alias("freshness_status"),
                      "bronze_rows", "silver_rows", "gold_rows", "realtime_rows",
                      rnd(safe_div(F.col("silver_rows").cast("double"), F.col("bronze_rows")) * 100, 1)
                      .alias("silver_retention_pct"),
                      rnd(safe_div(F.col("gold_rows").cast("double"), F.col("silver_rows")) * 100, 1)
                      .alias("gold_retention_pct"),
                      "null_shipment_ids", "dup_shipment_ids", "negative_delays",
                      F.when(bad, "DQ VIOLATIONS FOUND").otherwise("OK").alias("dq_status"))


def rt_freshness(wh, max_age_h: float = 0.25) -> DataFrame:
    """K7: age of the newest row of the live shipments table vs. 15 minutes."""
    live_rows = latest_per_key(wh.stg_shipments.select("shipment_id", "_loaded_at", "ata"),
                               ["shipment_id"], ["_loaded_at"]).filter(F.col("ata").isNull())
    g = live_rows.agg(F.max("_loaded_at").alias("latest_ts"))
    age = F.timestamp_diff("SECOND", F.col("latest_ts"), _as_of(wh)) / 3600.0
    return g.select(F.lit("realtime.dt_active_shipments").alias("table_name"), "latest_ts",
                    F.round(age, 2).alias("age_hours"),
                    F.when(age <= max_age_h, "PASS").otherwise("FAIL").alias("freshness_check"))


# ------------------------------------------------------------- dashboards
def dash_congestion_map(wh) -> DataFrame:
    """O1: congestion level per port with coordinates."""
    return wh.port_congestion_24h.select("port_code", "port_name", "lat", "lon", "congestion_level")


def dash_delay_trend(wh) -> DataFrame:
    """O2: mean delay by carrier name and ETA month."""
    c = wh.dim_carrier.select("carrier_key", "carrier_name")
    dd = wh.dim_date_b.select(F.col("date_key").alias("eta_date_key"), "year_month")
    f = wh.fct_shipment_events.join(c, "carrier_key").join(dd, "eta_date_key")
    return (f.groupBy("carrier_name", "year_month")
            .agg(F.count(F.lit(1)).alias("shipments"), rnd(F.avg("delay_hours"), 2).alias("avg_delay_hours")))


def dash_active_by_category(wh) -> DataFrame:
    """O3: live in-transit shipments per delay band."""
    return wh.active_shipments.groupBy("delay_category").agg(F.count(F.lit(1)).alias("active_shipments"))


def dash_cost_by_commodity(wh) -> DataFrame:
    """Landed cost by commodity of the customs entries.  A shipment's cost is divided
    among the commodities of its entries by their declared value, to the cent: every
    entry counts and the shares of a shipment add up to its cost."""
    entries = (wh.dim_customs_entry.groupBy("shipment_id", "commodity_code")
               .agg(F.count(F.lit(1)).alias("entries"), F.sum(F.coalesce("declared_value_usd", F.lit(0))).alias("value")))
    cost = wh.fct_landed_cost.groupBy("shipment_id").agg(F.sum("total_landed_cost_php").alias("cost"))
    shared = share_out(cost.join(entries, "shipment_id"), "shipment_id", "cost", "value", "entries", "commodity_code")
    return (shared.groupBy("commodity_code")
            .agg(F.count(F.lit(1)).alias("shipments"), F.sum("entries").alias("customs_entries"),
                 F.sum("share").cast("decimal(38,2)").alias("total_landed_cost_php")))


def dash_dwell_by_port(wh) -> DataFrame:
    """Mean dwell per port (the chart orders it descending)."""
    p = wh.dim_port_b.select("port_key", "port_code", "port_name")
    return (wh.fct_port_dwell.join(p, "port_key").groupBy("port_code", "port_name")
            .agg(rnd(F.avg("dwell_hours"), 2).alias("avg_dwell_hours"))
            .orderBy(F.col("avg_dwell_hours").desc_nulls_first(), F.col("port_code")))

