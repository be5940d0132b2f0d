"""Registered queries: Spark implementations and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the DuckDB
SQL for the same result (absent for stream/ingest operators, which are
checked on row counts and by the tests).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle import models as om
from .plans.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_WH: dict = {}


def warehouse(spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
    """One Warehouse per (session, dir, options): DataFrames are reused
    between queries of a run, never results."""
    kw.setdefault("store_layers", True)
    key = (id(spark), sf_dir, tuple(sorted(kw.items())))
    wh = _WH.get(key)
    if wh is None or wh.spark is not spark:
        wh = _WH[key] = Warehouse(spark, sf_dir, **kw)
    return wh


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def model_query(name: str, attr: str | None = None, oracle_name: str | None = None, **kw):
    """Register a Warehouse attribute as a query with the oracle model of the same name."""
    attr = attr or name

    def fn(spark, sf_dir):
        return getattr(warehouse(spark, sf_dir, **kw), attr)

    register(name, om.model(oracle_name or name))(fn)


for _m in ["stg_vessel_calls", "stg_shipments", "stg_customs_entries", "dim_date", "dim_port",
           "dim_vessel", "dim_carrier", "dim_shipment", "dim_customs_entry", "fct_port_dwell",
           "fct_shipment_events", "fct_landed_cost", "carrier_performance",
           "port_throughput_daily", "customs_clearance_kpi", "commodity_cost_summary",
           "congestion_delay_impact", "port_catchment_area"]:
    model_query(_m)


# --------------------------------------------------------------- reports
def _wh_query(name: str, fn, oracle: str | None, **kw):
    register(name, oracle)(lambda spark, sf_dir: fn(warehouse(spark, sf_dir, **kw)))


def _register_reports() -> None:
    from .oracle.reports import SQL
    from .plans import marts, monitoring, quality, reports

    def models(wh):
        names = set(quality.NOT_NULL) | set(quality.UNIQUE) | {m for m, _, _ in quality.ACCEPTED} \
            | {m for m, _, _ in quality.EXPRESSIONS} | set(quality.GRAINS)
        return {n: getattr(wh, n) for n in names}

    simple = {
        "active_shipments": lambda wh: wh.active_shipments,
        "port_congestion_24h": lambda wh: wh.port_congestion_24h,
        "fx_max_to_date": lambda wh: reports.fx_lookup(wh, "max_to_date"),
        "fx_asof": lambda wh: reports.fx_lookup(wh, "asof"),
        "fct_landed_cost_asof": reports.landed_cost_asof,
        "delay_bands": reports.delay_bands,
        "join_inner_dim": reports.join_inner_dim,
        "percentiles": reports.percentiles,
        "rolling_7d_dwell": reports.rolling_7d_dwell,
        "weekly_bucket": reports.weekly_bucket,
        "geo_cell_heatmap": reports.geo_cell_heatmap,
        "port_distance": lambda wh: marts.port_distance(wh.dim_port),
        "customs_tax_recompute": reports.customs_tax_recompute,
        "dq_not_null": lambda wh: quality.dq_not_null(models(wh)),
        "dq_unique": lambda wh: quality.dq_unique(models(wh)),
        "dq_accepted_values": lambda wh: quality.dq_accepted_values(models(wh)),
        "dq_expression": lambda wh: quality.dq_expression(models(wh)),
        "dq_singular_dwell": lambda wh: quality.dq_singular_dwell(wh.fct_port_dwell),
        "dq_grain": lambda wh: quality.dq_grain(models(wh)),
        "source_freshness": lambda wh: quality.source_freshness(
            {"raw_vessel_calls": wh.raw_vessel_calls, "raw_shipments": wh.raw_shipments,
             "raw_customs_entries": wh.raw_customs_entries}, wh.as_of),
        "outliers_iqr": lambda wh: quality.outliers_iqr(
            {"fct_port_dwell.dwell_hours": (wh.fct_port_dwell, "dwell_hours"),
             "fct_shipment_events.delay_hours": (wh.fct_shipment_events, "delay_hours")}),
        "data_tests": lambda wh: quality.data_tests(
            models(wh), {n: getattr(wh, n) for n in ("raw_vessel_calls", "raw_shipments", "raw_customs_entries")}, wh.as_of),
        "bronze_freshness": monitoring.bronze_freshness,
        "fact_freshness": monitoring.fact_freshness,
        "row_counts": monitoring.row_counts,
        "layer_retention": monitoring.layer_retention,
        "daily_load_volume": monitoring.daily_load_volume,
        "null_rates": monitoring.null_rates,
        "duplicate_keys": monitoring.duplicate_keys,
        "range_checks": monitoring.range_checks,
        "accepted_value_violations": monitoring.accepted_value_violations,
        "orphans": monitoring.orphans,
        "tariff_coverage": monitoring.tariff_coverage,
        "fx_coverage": monitoring.fx_coverage,
        "delay_distribution": monitoring.delay_distribution,
        "port_congestion_rate": monitoring.port_congestion_rate,
        "carrier_on_time": monitoring.carrier_on_time,
        "cost_by_cargo_type": monitoring.cost_by_cargo_type,
        "customs_time_by_type": monitoring.customs_time_by_type,
        "rt_sanity": monitoring.rt_sanity,
        "usage_daily": monitoring.usage_daily,
        "slow_query_topk": monitoring.slow_query_topk,
        "scan_ratio_topk": monitoring.scan_ratio_topk,
        "active_idle_ratio": monitoring.active_idle_ratio,
        "refresh_usage": monitoring.refresh_usage,
        "health_summary": monitoring.health_summary,
        "rt_freshness": monitoring.rt_freshness,
        "dash_congestion_map": monitoring.dash_congestion_map,
        "dash_delay_trend": monitoring.dash_delay_trend,
        "dash_active_by_category": monitoring.dash_active_by_category,
        "dash_cost_by_commodity": monitoring.dash_cost_by_commodity,
        "dash_dwell_by_port": monitoring.dash_dwell_by_port,
        "union_checks": reports.union_checks,
    }
    for name, fn in simple.items():
        _wh_query(name, fn, SQL[name])
    # rows-only: approximate percentiles have no exact oracle
    _wh_query("percentiles_approx", lambda wh: reports.percentiles(wh, approx=True), None)


_register_reports()


def _register_runs() -> None:
    from .oracle.models import model as om_model
    from .oracle.reports import SQL
    from .plans import incremental_runs as ir
    from .plans import ingest_runs as gr
    from .plans import sink_runs as kr
    from .plans import stream_runs as sr

    full_events = om_model("fct_shipment_events")
    _wh_query("incremental_upsert", ir.incremental_upsert, full_events)
    _wh_query("incremental_rerun_noop", ir.incremental_rerun_noop, full_events)
    _wh_query("incremental_key_move", ir.incremental_key_move, full_events)
    _wh_query("throughput_incremental", ir.throughput_incremental, om.model("port_throughput_daily"))
    _wh_query("carrier_performance_redelivered", ir.carrier_performance_redelivered, om.model_over(
        "carrier_performance", "raw_shipments", om.REDELIVERED))
    _wh_query("congestion_incremental", ir.congestion_incremental, om.model("congestion_delay_impact"))
    _wh_query("throughput_late_rows", ir.throughput_late_rows, om.model("port_throughput_daily"))
    _wh_query("late_rows_lookback", ir.late_rows_lookback, full_events)
    _wh_query("csv_null_tokens", gr.csv_null_tokens, om_model("raw_vessel_calls"))
    _wh_query("incremental_full_refresh", ir.incremental_full_refresh, full_events)
    for name in ("load_audit", "csv_rejects", "csv_rejected_lines", "csv_header_load", "skipped_inputs"):
        _wh_query(name, getattr(gr, name), SQL[name])
    for name in ("bronze_append", "bronze_table", "lake_tables", "catchment_in_order", "berth_wait_minutes"):
        _wh_query(name, getattr(kr, name), SQL[name])
    _wh_query("ingest_idempotent", gr.ingest_idempotent, om_model("raw_shipments"))
    _wh_query("seed_ports", gr.seed_ports, om_model("ph_ports"))
    _wh_query("fx_feed_clean", gr.fx_feed_clean, SQL["fx_feed_clean"])
    _wh_query("fx_feed_validate", gr.fx_feed_validate, SQL["fx_feed_validate"])
    _wh_query("stream_active_shipments", sr.stream_active_shipments, SQL["active_shipments"])
    _wh_query("stream_port_congestion", sr.stream_port_congestion, SQL["stream_port_congestion"])
    _wh_query("stream_fact_upsert", sr.stream_fact_upsert, full_events)
    _wh_query("stream_dedup", sr.stream_dedup, om_model("raw_shipments"))
    _wh_query("stream_unknown_ports", sr.stream_unknown_ports, SQL["stream_unknown_ports"])
    _wh_query("stream_late_calls", sr.stream_late_calls, SQL["stream_late_calls"])
    _wh_query("stream_lag", sr.stream_lag, SQL["stream_lag"])


_register_runs()
