"""Gold dimensions (survey J4-J9)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lookups
from ..functions.scalars import dow_sunday0, grid_cell

# FIXED VALUES — calendar span of dim_date.
CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)
CALENDAR_ROWS = 4018


def dim_date(spark: SparkSession, start: dt.date = CALENDAR_START,
             end: dt.date = CALENDAR_END) -> DataFrame:
    """One row per day, generated by ``range`` (no input scan)."""
    n = (end - start).days + 1
    d = F.col("date_key")
    dow = dow_sunday0(d)
    return (spark.range(n, numPartitions=1)
            .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_key"))
            .select("date_key",
                    F.year(d).alias("year_num"),
                    F.quarter(d).alias("quarter_num"),
                    F.month(d).alias("month_num"),
                    F.date_format(d, "MMM").alias("month_name"),
                    F.weekofyear(d).alias("week_num"),
                    F.dayofmonth(d).alias("day_of_month"),
                    dow.alias("day_of_week"),
                    F.date_format(d, "EEE").alias("day_name"),
                    dow.isin(0, 6).alias("is_weekend"),
                    F.date_format(d, "yyyy-MM").alias("year_month"),
                    F.concat(F.year(d).cast("string"), F.lit("-Q"),
                             F.quarter(d).cast("string")).alias("year_quarter")))


def dim_port(ports: DataFrame) -> DataFrame:
    """Ports seed with a surrogate key and two grid cells (H3 re-aimed)."""
    return ports.select(F.md5("port_code").alias("port_key"), "port_code", "port_name",
                        "region", "port_type", "lat", "lon",
                        grid_cell("lat", "lon", 5).alias("cell_res5"),
                        grid_cell("lat", "lon", 7).alias("cell_res7"))


def dim_vessel(calls: DataFrame) -> DataFrame:
    """One row per vessel; type = alphabetically first cargo type.

    ``ROW_NUMBER() OVER (PARTITION BY imo ORDER BY cargo) = 1`` on distinct
    pairs equals ``MIN(cargo)`` per vessel with NULLs last, and ``min`` is a
    partial (map-side) aggregate, so a vessel with a third of all calls is
    still combined before the shuffle.
    """
    return (calls.filter(F.col("vessel_imo").isNotNull())
            .groupBy("vessel_imo").agg(F.min("cargo_type").alias("vessel_type"))
            .select(F.md5("vessel_imo").alias("vessel_key"), "vessel_imo",
                    F.lit(None).cast("string").alias("vessel_name"),
                    F.lit(None).cast("string").alias("flag_country"),
                    "vessel_type",
                    F.lit(None).cast("int").alias("capacity_teu")))


def dim_carrier(shipments: DataFrame) -> DataFrame:
    """Distinct carrier codes with name and alliance lookups."""
    c = F.col("carrier_code")
    return (shipments.select("carrier_code").distinct()
            .select(F.md5(c).alias("carrier_key"), c,
                    lookups.carrier_name(c).alias("carrier_name"),
                    lookups.carrier_alliance(c).alias("alliance")))


def dim_shipment(shipments: DataFrame) -> DataFrame:
    """One row per staged shipment with the inferred incoterm."""
    return shipments.select(F.md5("shipment_id").alias("shipment_key"), "shipment_id",
                            "bl_number", "origin_port_code", "dest_port_code",
                            "carrier_code", "cargo_type", "commodity_code",
                            lookups.incoterm(F.col("cargo_type")).alias("incoterm"),
                            "declared_value_usd")


CUSTOMS_COLUMNS = ["entry_number", "shipment_id", "bl_number", "commodity_code",
                   "entry_type", "declared_value_usd", "tariff_rate_pct", "duties_usd",
                   "vat_usd", "total_tax_usd", "lodge_date", "assessment_date",
                   "release_date", "processing_days", "payment_mode", "port_code"]


def dim_customs_entry(customs: DataFrame) -> DataFrame:
    """Staged customs entries with a surrogate key."""
    return (customs.filter(F.col("entry_number").isNotNull())
            .select(F.md5("entry_number").alias("customs_key"), *CUSTOMS_COLUMNS))
