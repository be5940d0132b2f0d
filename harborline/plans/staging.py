"""Silver layer (survey J1-J3): cleaning views over the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domain as d
from ..functions.scalars import hours_between


def _ut(c: str):
    return F.upper(F.trim(F.col(c)))


def stg_vessel_calls(raw: DataFrame, hour_mode: str = "boundary") -> DataFrame:
    """Repaired dwell, upper-cased codes; drops calls without arrival or
    with a non-positive dwell.  The predicate repeats the repair expression
    (not the alias), like the reference."""
    dwell = F.coalesce(F.col("dwell_hours").cast("long"),
                       hours_between("arrival_ts", "departure_ts", hour_mode))
    return (raw.filter(F.col("arrival_ts").isNotNull() & (dwell > 0))
            .select("vessel_imo", _ut("port_code").alias("port_code"),
                    "arrival_ts", "berth_ts", "departure_ts",
                    dwell.alias("dwell_hours"), "anchorage_wait_h",
                    F.upper("cargo_type").alias("cargo_type"), "teu_count", "_loaded_at"))


def stg_shipments(raw: DataFrame, clamp_category: bool = False,
                  hour_mode: str = "boundary") -> DataFrame:
    """Delay hours and band; codes upper-cased but not trimmed."""
    return (raw.filter(F.col("shipment_id").isNotNull())
            .select("shipment_id", "bl_number",
                    F.upper("origin_port").alias("origin_port_code"),
                    F.upper("dest_port").alias("dest_port_code"),
                    F.upper("carrier_code").alias("carrier_code"),
                    F.upper("vessel_imo").alias("vessel_imo"),
                    "etd", "eta", "ata",
                    d.delay_hours("eta", "ata", hour_mode).alias("delay_hours"),
                    d.delay_category("eta", "ata", clamp_category, hour_mode).alias("delay_category"),
                    "cargo_type", "commodity_code", "declared_value_usd",
                    "freight_usd", "insurance_usd", "_loaded_at"))


def stg_customs_entries(raw: DataFrame) -> DataFrame:
    """Trimmed, upper-cased codes; processing days repaired from dates."""
    days = F.coalesce(F.col("processing_days"),
                      F.datediff("release_date", "lodge_date")).cast("int")
    return (raw.filter(F.col("entry_number").isNotNull() & F.col("shipment_id").isNotNull())
            .select("entry_number", "shipment_id", "bl_number",
                    _ut("commodity_code").alias("commodity_code"),
                    _ut("entry_type").alias("entry_type"),
                    "declared_value_usd", "tariff_rate_pct", "duties_usd", "vat_usd",
                    "total_tax_usd", "lodge_date", "assessment_date", "release_date",
                    days.alias("processing_days"),
                    _ut("payment_mode").alias("payment_mode"),
                    _ut("port_code").alias("port_code"), "_loaded_at"))
