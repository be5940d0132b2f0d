"""Wiring of all models for one input directory.

``Warehouse(spark, sf_dir)`` exposes every layer as a lazily built DataFrame
(nothing is computed until an action).  Each model is a plain function in
``staging``/``dims``/``facts``/``marts``; this class only passes inputs along,
so Catalyst sees one plan per query and prunes and pushes filters end to end.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.broadcast import checked_broadcast
from ..operators.files import file_count
from ..operators.latest import latest_rows
from ..session import shared_dir
from ..sources.testdata import Bronze, load_bronze
from . import dims, facts, marts, staging

# Fixed evaluation time used instead of the wall clock, so results are
# reproducible (the reference uses CURRENT_TIMESTAMP()).
DEFAULT_AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
SEED_MAX_ROWS = 100_000
# Data-derived dimensions (carriers, vessels) are broadcast below this size;
# above it the join falls back to a shuffle join.
DIM_MAX_ROWS = 500_000   # of about 100 bytes


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.datetime = DEFAULT_AS_OF,
                 bronze: Bronze | None = None, fx_mode: str = "max_to_date",
                 clamp_category: bool = False, vessel_source: str = "silver",
                 store_layers: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.fx_mode = fx_mode
        self.clamp_category = clamp_category
        self.vessel_source = vessel_source
        self._bronze = bronze
        self._run_id = uuid.uuid4().hex[:12]
        # store_layers: what costs a shuffle of whole rows, the staged shipments (a join of
        # two feeds), is written once per warehouse, bucketed by shipment.  The other layers
        # are projections of a feed, or follow from the buckets without a shuffle: a query
        # derives the columns it needs, which is less work than to write them all.
        self.store_layers = store_layers

    def materialize(self, name: str, df: DataFrame) -> DataFrame:
        """Write a model once per warehouse to the shared checkpoint folder and
        read it back: the lineage is cut and the planner sees the real size
        (as the reference materialises its dimensions as tables)."""
        path = shared_dir(self.spark, f"warehouse/{self._run_id}/{name}")
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def with_stored_feed(self) -> Warehouse:
        """The same warehouse over a shipment feed that is written once: the feed is a join of
        two tables, and a run that loads it step by step reads it many times.  The layers
        are views over it."""
        bronze = replace(self.bronze, raw_shipments=self.materialize("raw_shipments", self.raw_shipments))
        return Warehouse(self.spark, self.sf_dir, self.as_of, bronze, self.fx_mode, self.clamp_category,
                         self.vessel_source)

    def by_id(self, name: str, df: DataFrame, key: str = "shipment_id") -> DataFrame:
        """A stored layer as large as the feed, bucketed by ``key``: what is derived from it
        joins, and is reduced to one row, on that key without a shuffle."""
        if not self.store_layers:
            return df
        n = file_count(df, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        table = f"harborline_{self._run_id}_{name}"
        path = shared_dir(self.spark, f"warehouse/{self._run_id}/{name}")
        (df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key)
         .option("path", path).saveAsTable(table))
        return self.spark.table(table)

    # -- bronze + seeds -------------------------------------------------------
    @cached_property
    def bronze(self) -> Bronze:
        return self._bronze or load_bronze(self.spark, self.sf_dir)

    @property
    def raw_vessel_calls(self) -> DataFrame:
        return self.bronze.raw_vessel_calls

    @property
    def raw_shipments(self) -> DataFrame:
        return self.bronze.raw_shipments

    @property
    def raw_customs_entries(self) -> DataFrame:
        return self.bronze.raw_customs_entries

    @property
    def ph_tariff_rates(self) -> DataFrame:
        return self.bronze.ph_tariff_rates

    @property
    def usd_php_rates(self) -> DataFrame:
        return self.bronze.usd_php_rates

    @cached_property
    def tariffs_b(self) -> DataFrame:
        return checked_broadcast(self.ph_tariff_rates, SEED_MAX_ROWS)

    # -- silver ---------------------------------------------------------------
    @cached_property
    def stg_vessel_calls(self) -> DataFrame:
        return staging.stg_vessel_calls(self.raw_vessel_calls)

    @cached_property
    def stg_shipments(self) -> DataFrame:
        return self.by_id("stg_shipments", staging.stg_shipments(self.raw_shipments, self.clamp_category))

    @cached_property
    def latest_shipments(self) -> DataFrame:
        """The latest version of every shipment."""
        return latest_rows(self.stg_shipments, ["shipment_id"], ["_loaded_at"])

    @cached_property
    def stg_customs_entries(self) -> DataFrame:
        return staging.stg_customs_entries(self.raw_customs_entries)

    # -- dimensions -----------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark)

    @cached_property
    def dim_date_b(self) -> DataFrame:
        return checked_broadcast(self.dim_date, known_rows=dims.CALENDAR_ROWS)

    @cached_property
    def dim_port(self) -> DataFrame:
        return dims.dim_port(self.bronze.ph_ports)

    @cached_property
    def dim_port_b(self) -> DataFrame:
        return checked_broadcast(self.dim_port, SEED_MAX_ROWS)

    @cached_property
    def dim_vessel(self) -> DataFrame:
        src = self.stg_vessel_calls if self.vessel_source == "silver" else self.raw_vessel_calls
        return self.materialize("dim_vessel", dims.dim_vessel(src))

    @cached_property
    def dim_vessel_b(self) -> DataFrame:
        """Broadcast only while the materialised vessel table is small."""
        return checked_broadcast(self.dim_vessel, DIM_MAX_ROWS)

    @cached_property
    def dim_carrier(self) -> DataFrame:
        return self.materialize("dim_carrier", dims.dim_carrier(self.stg_shipments))

    @cached_property
    def dim_carrier_b(self) -> DataFrame:
        return checked_broadcast(self.dim_carrier, DIM_MAX_ROWS)

    @cached_property
    def dim_shipment(self) -> DataFrame:
        # a projection (MD5 + lookup) of stored silver: not worth storing again
        return dims.dim_shipment(self.stg_shipments)

    @cached_property
    def dim_customs_entry(self) -> DataFrame:
        return dims.dim_customs_entry(self.stg_customs_entries)

    # -- facts ----------------------------------------------------------------
    @cached_property
    def fct_port_dwell(self) -> DataFrame:
        return facts.fct_port_dwell(self.stg_vessel_calls, self.dim_vessel_b, self.dim_date, self.dim_port_b)

    @cached_property
    def fct_shipment_events(self) -> DataFrame:
        return facts.fct_shipment_events(
            self.stg_shipments, self.dim_shipment, self.dim_date, self.dim_port_b, self.dim_carrier_b)

    @cached_property
    def fct_landed_cost(self) -> DataFrame:
        return facts.fct_landed_cost(
            self.stg_shipments, self.tariffs_b, self.usd_php_rates, self.as_of.date(), self.fx_mode)

    # -- marts ----------------------------------------------------------------
    @cached_property
    def carrier_performance(self) -> DataFrame:
        return marts.carrier_performance(self.fct_shipment_events, self.dim_carrier_b,
                                         self.latest_shipments, self.dim_port_b)

    @cached_property
    def port_throughput_daily(self) -> DataFrame:
        return marts.port_throughput_daily(self.fct_port_dwell, self.dim_port_b, self.dim_date_b)

    @cached_property
    def customs_clearance_kpi(self) -> DataFrame:
        return marts.customs_clearance_kpi(self.dim_customs_entry, self.dim_port_b)

    @cached_property
    def commodity_cost_summary(self) -> DataFrame:
        return marts.commodity_cost_summary(self.fct_landed_cost, self.latest_shipments,
                                            self.tariffs_b, self.dim_port_b)

    @cached_property
    def congestion_delay_impact(self) -> DataFrame:
        return marts.congestion_delay_impact(self.fct_port_dwell, self.fct_shipment_events,
                                             self.dim_port_b)

    @cached_property
    def port_pairs(self) -> DataFrame:
        return checked_broadcast(marts.port_pairs(self.dim_port), SEED_MAX_ROWS)

    @cached_property
    def port_catchment_area(self) -> DataFrame:
        return marts.port_catchment_area(self.fct_shipment_events, self.dim_port, self.port_pairs)

    # -- near-real-time twins -------------------------------------------------
    @cached_property
    def active_shipments(self) -> DataFrame:
        from . import live
        return live.active_shipments(self.latest_shipments, self.dim_port_b, self.as_of)

    @cached_property
    def port_congestion_24h(self) -> DataFrame:
        from . import live
        return live.port_congestion_24h(self.stg_vessel_calls, self.dim_port_b)
