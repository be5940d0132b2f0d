"""Declared schemas of the bronze tables and seeds (never inferred)."""

from __future__ import annotations

import re

from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

_TYPES = {"string": StringType(), "int": IntegerType(), "long": LongType(), "double": DoubleType(),
          "date": DateType(), "timestamp_ntz": TimestampNTZType()}


def _ddl(text: str) -> StructType:
    """``"name type, ..."`` -> StructType without needing a live session."""
    fields = []
    for part in re.split(r",\s*(?![^()]*\))", text.strip()):
        name, typ = part.split()
        m = re.fullmatch(r"decimal\((\d+),(\d+)\)", typ)
        fields.append(StructField(name, DecimalType(int(m[1]), int(m[2])) if m else _TYPES[typ]))
    return StructType(fields)


def with_column(schema: StructType, name: str, type_name: str) -> StructType:
    return StructType([*schema.fields, StructField(name, _TYPES[type_name])])


RAW_VESSEL_CALLS = _ddl(
    "vessel_imo string, port_code string, arrival_ts timestamp_ntz, berth_ts timestamp_ntz, "
    "departure_ts timestamp_ntz, dwell_hours int, anchorage_wait_h int, cargo_type string, "
    "teu_count int, _loaded_at timestamp_ntz")

RAW_SHIPMENTS = _ddl(
    "shipment_id string, bl_number string, origin_port string, dest_port string, carrier_code string, "
    "vessel_imo string, etd timestamp_ntz, eta timestamp_ntz, ata timestamp_ntz, cargo_type string, "
    "commodity_code string, declared_value_usd decimal(15,2), freight_usd decimal(15,2), "
    "insurance_usd decimal(15,2), _loaded_at timestamp_ntz")

RAW_CUSTOMS_ENTRIES = _ddl(
    "entry_number string, shipment_id string, bl_number string, commodity_code string, "
    "entry_type string, declared_value_usd decimal(15,2), tariff_rate_pct decimal(5,2), "
    "duties_usd decimal(15,2), vat_usd decimal(15,2), total_tax_usd decimal(15,2), lodge_date date, "
    "assessment_date date, release_date date, processing_days int, payment_mode string, "
    "port_code string, _loaded_at timestamp_ntz")

PH_PORTS = _ddl(
    "port_code string, port_name string, region string, port_type string, lat double, lon double")

PH_TARIFF_RATES = _ddl(
    "commodity_code string, description string, mfn_rate_pct decimal(5,2), atiga_rate_pct decimal(5,2)")

USD_PHP_RATES = _ddl(
    "rate_date date, usd_php_open double, usd_php_high double, usd_php_low double, "
    "usd_php_close double, usd_php_volume long, source string")

BRONZE = {"raw_vessel_calls": RAW_VESSEL_CALLS, "raw_shipments": RAW_SHIPMENTS,
          "raw_customs_entries": RAW_CUSTOMS_ENTRIES}
