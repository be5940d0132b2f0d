"""The oracle's own catalogue of declared tests, accepted values and limits.

FIXED VALUES, stated apart from the engine's, so that a wrong list in either shows up
as a mismatch.
"""

from __future__ import annotations

# FIXED VALUES — declared column tests per model.
NOT_NULL = {
    "raw_shipments": ["shipment_id"],
    "raw_customs_entries": ["entry_number"],
    "stg_vessel_calls": ["vessel_imo", "port_code", "arrival_ts", "dwell_hours", "anchorage_wait_h"],
    "stg_shipments": ["shipment_id", "delay_hours", "delay_category"],
    "stg_customs_entries": ["entry_number", "shipment_id", "processing_days"],
    "dim_date": ["date_key"],
    "dim_port": ["port_key", "port_code"],
    "dim_vessel": ["vessel_key", "vessel_imo"],
    "dim_carrier": ["carrier_key", "carrier_code"],
    "dim_shipment": ["shipment_key", "shipment_id"],
    "dim_customs_entry": ["customs_key", "entry_number"],
    "fct_port_dwell": ["dwell_hours", "anchorage_wait_h"],
    "fct_shipment_events": ["shipment_id", "delay_hours"],
    "fct_landed_cost": ["shipment_id", "total_landed_cost_php"],
    "port_catchment_area": ["shipment_id", "dest_port_code", "distance_km", "nearest_alt_port"],
    "carrier_performance": ["carrier_code", "origin_port_code", "dest_port_code", "total_shipments",
                            "on_time_pct"],
    "port_throughput_daily": ["port_code", "report_date", "vessel_calls", "avg_dwell_hours"],
    "customs_clearance_kpi": ["port_code", "entry_type", "payment_mode", "total_entries",
                              "avg_processing_days"],
    "commodity_cost_summary": ["commodity_code", "dest_port_code", "shipment_count",
                               "avg_landed_cost_php", "total_landed_cost_php"],
    "congestion_delay_impact": ["port_code", "week_start_date"],
}

UNIQUE = {
    "raw_shipments": ["shipment_id"],
    "raw_customs_entries": ["entry_number"],
    "stg_shipments": ["shipment_id"],
    "stg_customs_entries": ["entry_number"],
    "dim_date": ["date_key"],
    "dim_port": ["port_key", "port_code"],
    "dim_vessel": ["vessel_key", "vessel_imo"],
    "dim_carrier": ["carrier_key", "carrier_code"],
    "dim_shipment": ["shipment_key", "shipment_id"],
    "dim_customs_entry": ["customs_key", "entry_number"],
    "fct_shipment_events": ["shipment_id"],
    "fct_landed_cost": ["shipment_id"],
}

ENTRY_TYPES = ["FORMAL", "INFORMAL", "WAREHOUSING", "CONSUMPTION", "TRANSIT", "TRANSSHIPMENT",
               "TEMPORARY_IMPORTATION", "TEMPORARY_EXPORTATION", "EXPORT_DECLARATION",
               "REEXPORTATION", "REIMPORTATION", "DUTY_DRAWBACK", "FREEPORT_ENTRY",
               "FREEZONE_ENTRY", "COURIER_ENTRY", "POSTAL_ENTRY", "PROJECT_CARGO_ENTRY",
               "GOVERNMENT_IMPORTATION", "DIPLOMATIC_ENTRY", "RELIEF_GOODS_ENTRY",
               "BONDED_TRANSFER", "SPECIAL_PERMIT_ENTRY"]
PAYMENT_MODES = ["CASH", "SURETY_BOND", "DEFERRED", "BANK_TRANSFER", "MANAGER_CHECK",
                 "LETTER_OF_CREDIT", "TELEGRAPHIC_TRANSFER", "DOCUMENTARY_COLLECTION", "E_PAYMENT",
                 "ONLINE_BANKING", "CUSTOMS_ACCOUNT", "ADVANCE_DEPOSIT", "ESCROW_ACCOUNT",
                 "CORPORATE_CREDIT", "GUARANTEE_BOND", "TRUST_RECEIPT"]
DELAY_CATEGORIES = ["ON_TIME", "MINOR_DELAY", "MODERATE_DELAY", "SEVERE_DELAY"]
CONGESTION_LEVELS = ["CRITICAL", "HIGH", "MODERATE", "NORMAL"]

ACCEPTED = [
    ("stg_shipments", "delay_category", DELAY_CATEGORIES),
    ("stg_customs_entries", "entry_type", ENTRY_TYPES),
    ("stg_customs_entries", "payment_mode", PAYMENT_MODES),
    ("customs_clearance_kpi", "entry_type", ENTRY_TYPES),
    ("customs_clearance_kpi", "payment_mode", PAYMENT_MODES),
    ("congestion_delay_impact", "congestion_level", CONGESTION_LEVELS),
]

# expression_is_true: the column name is prefixed to the expression.
EXPRESSIONS = [
    ("stg_vessel_calls", "dwell_hours", "> 0"),
    ("fct_port_dwell", "dwell_hours", ">= 0"),
    ("port_catchment_area", "distance_km", "> 0 AND distance_km <= 200"),
]

# Grain (composite keys) stated for the marts.
GRAINS = {
    "carrier_performance": ["carrier_code", "origin_port_code", "dest_port_code"],
    "port_throughput_daily": ["port_code", "report_date"],
    "customs_clearance_kpi": ["port_code", "entry_type", "payment_mode"],
    "commodity_cost_summary": ["commodity_code", "commodity_desc", "cargo_type", "dest_port_code"],
    "congestion_delay_impact": ["port_code", "week_start_date"],
}

NOT_NULL_WHERE = {("stg_shipments", "delay_hours"): "ata IS NOT NULL",
                  ("fct_shipment_events", "delay_hours"): "ata IS NOT NULL"}

MONITORED_CARGO = ["FCL", "LCL", "RORO", "BULK"]
MONITORED_ENTRY_TYPES = ["FORMAL", "INFORMAL", "WAREHOUSING"]
MONITORED_PAYMENT_MODES = ["CASH", "SURETY_BOND", "DEFERRED"]
STALE_HOURS, CRITICAL_HOURS = 5, 8
