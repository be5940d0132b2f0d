"""Declared data tests and data-quality reports (survey 2.K).

The catalogue below lists the declared column tests per model.  Each report
runs the tests of one kind over all models and returns
``(model, column_name, test, failing_values, failing_rows)``-shaped rows; a
pipeline run fails when any count is non-zero.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import lit_ntz
from ..operators.checks import accepted_values_violations, unique_violations
from ..operators.histogram import histogram_aggregate, nonnull_count

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

# In-transit shipments have no delay yet; their not_null test is
# restricted to arrived rows.
NOT_NULL_WHERE = {("stg_shipments", "delay_hours"): "ata IS NOT NULL",
                  ("fct_shipment_events", "delay_hours"): "ata IS NOT NULL"}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def dq_not_null(models: dict[str, DataFrame]) -> DataFrame:
    """K1: NULL counts, all tested columns of a model in one aggregate."""
    out = []
    for m, cols in NOT_NULL.items():
        df = models[m]
        aggs = []
        for c in cols:
            cond = F.col(c).isNull()
            where = NOT_NULL_WHERE.get((m, c))
            if where:
                cond = cond & F.expr(where)
            aggs.append(F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(c))
        row = df.agg(*aggs)
        stack = ", ".join(f"'{c}', coalesce(`{c}`, 0L)" for c in cols)
        out.append(row.selectExpr(f"'{m}' as model", f"stack({len(cols)}, {stack}) as (column_name, failing_rows)"))
    return _union(out)


def dq_unique(models: dict[str, DataFrame]) -> DataFrame:
    """K2: duplicated non-null values per tested key column."""
    out = [unique_violations(models[m], c).select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                                                    "failing_values", "failing_rows")
           for m, cols in UNIQUE.items() for c in cols]
    return _union(out)


def dq_accepted_values(models: dict[str, DataFrame], checks=None) -> DataFrame:
    """K3: distinct values outside the accepted list (NULL passes)."""
    out = [accepted_values_violations(models[m], c, vals)
           .select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                   "failing_values", "failing_rows")
           for m, c, vals in (checks or ACCEPTED)]
    return _union(out)


def dq_expression(models: dict[str, DataFrame]) -> DataFrame:
    """K4: rows where ``NOT (<column> <expression>)`` is true."""
    out = []
    for m, c, e in EXPRESSIONS:
        bad = F.expr(f"NOT ({c} {e})")
        out.append(models[m].agg(F.sum(F.when(bad, 1).otherwise(0)).cast("long").alias("n"))
                   .select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                           F.lit(e).alias("expression"),
                           F.coalesce("n", F.lit(0).cast("long")).alias("failing_rows")))
    return _union(out)


def dq_singular_dwell(fct_port_dwell: DataFrame) -> DataFrame:
    """K5: the singular test returns the offending rows (none expected)."""
    return fct_port_dwell.filter(F.col("dwell_hours") < 0)


def dq_grain(models: dict[str, DataFrame]) -> DataFrame:
    """Keys of the stated grain that occur more than once."""
    out = []
    for m, keys in GRAINS.items():
        g = (models[m].groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
             .agg(F.count(F.lit(1)).cast("long").alias("duplicate_keys"),
                  F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_in_duplicates")))
        out.append(g.select(F.lit(m).alias("model"), F.lit(",".join(keys)).alias("grain"),
                            "duplicate_keys", "rows_in_duplicates"))
    return _union(out)


def freshness_status(age_h, warn_h: float, error_h: float):
    return (F.when(age_h > error_h, "ERROR").when(age_h > warn_h, "WARN").otherwise("OK"))


def source_freshness(tables: dict[str, DataFrame], as_of, warn_h: float = 8, error_h: float = 24) -> DataFrame:
    """K6: age of the newest ``_loaded_at`` per source vs. warn/error limits."""
    out = []
    for name, df in tables.items():
        g = df.agg(F.max("_loaded_at").alias("max_loaded_at"))
        age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), lit_ntz(as_of)) / 3600.0
        out.append(g.select(F.lit(name).alias("source_table"), "max_loaded_at",
                            F.round(age, 2).alias("age_hours"),
                            freshness_status(age, warn_h, error_h).alias("freshness_status")))
    return _union(out)


def outliers_iqr(columns: dict[str, tuple[DataFrame, str]], k: float = 1.5) -> DataFrame:
    """K8: Tukey fences from exact quartiles; count of values outside.

    All columns are unpivoted to (label, value) and counted per value, so the quartiles
    and the outliers both come from a histogram that is built map-side; no task sees
    more than one row per distinct value of a column."""
    rows = None
    for label, (df, c) in columns.items():
        part = df.select(F.lit(label).alias("column_check"), F.col(c).cast("double").alias("x"))
        rows = part if rows is None else rows.unionByName(part)
    # a label without rows still has its line
    labels = rows.sparkSession.createDataFrame([(label, None) for label in columns], "column_check string, x double")
    rows = rows.unionByName(labels)
    fences = histogram_aggregate(rows, ["column_check"], F.col("x"), {"q1": 0.25, "q3": 0.75}, {},
                                 {"checked_rows": F.sum(nonnull_count()).cast("long")})
    spread = F.lit(k) * (F.col("q3") - F.col("q1"))
    fences = fences.withColumns({"lower_fence": F.col("q1") - spread, "upper_fence": F.col("q3") + spread})
    outside = (F.col("x") < F.col("lower_fence")) | (F.col("x") > F.col("upper_fence"))
    counted = rows.groupBy("column_check", "x").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(fences), "column_check")
    return (counted.groupBy("column_check", "q1", "q3", "lower_fence", "upper_fence", "checked_rows")
            .agg(F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).cast("long").alias("outlier_count"))
            .select("column_check", "q1", "q3", "lower_fence", "upper_fence", "outlier_count", "checked_rows"))


def data_tests(models: dict[str, DataFrame], sources: dict[str, DataFrame], as_of) -> DataFrame:
    """All data tests of a run, one row each: test, model, column_name, failing_rows and
    severity.  Freshness warns before it fails; outliers only warn."""
    def named(df: DataFrame, test: str, severity="error", **columns) -> DataFrame:
        given = {"test": F.lit(test), "severity": severity if isinstance(severity, F.Column) else F.lit(severity), **columns}
        return df.withColumns(given).select("test", "model", "column_name", F.col("failing_rows").cast("long"), "severity")
    dwell = dq_singular_dwell(models["fct_port_dwell"]).agg(F.count(F.lit(1)).alias("failing_rows"))
    fresh = source_freshness(sources, as_of)
    stale = F.col("freshness_status") != "OK"
    fenced = outliers_iqr({f"{m}.{c}": (models[m], c) for m, c in OUTLIER_COLUMNS})
    return _union([
        named(dq_not_null(models), "not_null"), named(dq_unique(models), "unique"),
        named(dq_accepted_values(models), "accepted_values"),
        named(dq_expression(models), "expression_is_true"),
        named(dwell, "singular", model=F.lit("fct_port_dwell"), column_name=F.lit("dwell_hours")),
        named(dq_grain(models).withColumn("failing_rows", F.col("duplicate_keys")), "grain", column_name=F.col("grain")),
        named(fresh, "freshness", F.when(F.col("freshness_status") == "ERROR", "error").otherwise("warn"),
              model=F.col("source_table"), column_name=F.lit("_loaded_at"), failing_rows=stale.cast("long")),
        named(fenced, "outliers", "warn", model=F.split_part("column_check", F.lit("."), F.lit(1)),
              column_name=F.split_part("column_check", F.lit("."), F.lit(2)), failing_rows=F.col("outlier_count"))])


OUTLIER_COLUMNS = [("fct_port_dwell", "dwell_hours"), ("fct_shipment_events", "delay_hours")]

__all__ = ["dq_not_null", "dq_unique", "dq_accepted_values", "dq_expression", "dq_singular_dwell",
           "dq_grain", "source_freshness", "outliers_iqr", "data_tests"]
