"""Binding of the driver's TPC-H-like tables to the shipping domain.

The bronze tables, seeds and log tables of the domain are *derived by Spark*
from the parquet tables in ``sf_dir`` with fixed column expressions, so their
size grows with the input.  The same expressions are written as DuckDB SQL in
``harborline.oracle.bindings``.  Every derived time column is timestamp_ntz.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import day_start, days, hours, trunc_second

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events"]

# Dates of the TPC-H tables (1995-2001) are moved by 28 years: the same
# weekdays, and inside the 2020-2030 calendar.
def year_shift() -> F.Column:
    return F.make_ym_interval(F.lit(28))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return c.cast("string")


def D(text: str) -> F.Column:
    """An exact decimal literal (``F.lit(0.01)`` would be a double)."""
    return F.expr(text)


def ports(nation: DataFrame, region: DataFrame) -> DataFrame:
    """``ph_ports`` seed: one port per nation, placed on a 5 x 5 lat/lon grid."""
    k = F.col("n_nationkey")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_name").alias("port_code"),
                    F.concat(F.lit("Port of "), F.col("n_name")).alias("port_name"),
                    F.col("r_name").alias("region"),
                    F.when(k % 3 == 0, "international").otherwise("domestic").alias("port_type"),
                    (D("5.0") + D("1.3") * (k % 5)).cast("double").alias("lat"),
                    (D("118.0") + D("1.3") * F.floor(k / 5)).cast("double").alias("lon")))


def vessel_calls(events: DataFrame) -> DataFrame:
    """``raw_vessel_calls``: one call per event."""
    eid = F.col("event_id")
    base = events.select(
        eid,
        F.concat(F.lit("IMO"), _s(F.lit(9000001) + F.col("user_id"))).alias("vessel_imo"),
        F.concat(F.lit(" nation_"), _s(eid % 26), F.lit(" ")).alias("port_code"),
        trunc_second("ts").alias("t0"),
        F.when(eid % 10 < 3, 12 + eid % 61).otherwise(F.lit(0).cast("long")).alias("w"),
        (6 + eid % 91).alias("stay"),
        F.when(F.col("event_type") == "click", "fcl")
        .when(F.col("event_type") == "view", "lcl")
        .when(F.col("event_type") == "purchase", "roro")
        .otherwise("bulk").alias("cargo_type"))
    w, stay, t0 = F.col("w"), F.col("stay"), F.col("t0")
    return base.select(
        "vessel_imo", "port_code",
        F.when(eid % 97 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(t0).alias("arrival_ts"),
        (t0 + hours(w)).alias("berth_ts"),
        (t0 + hours(w + stay)).alias("departure_ts"),
        F.when(eid % 7 == 0, F.lit(None)).when(eid % 89 == 0, F.lit(0))
        .otherwise(w + stay).cast("int").alias("dwell_hours"),
        w.cast("int").alias("anchorage_wait_h"),
        "cargo_type",
        (10 + eid % 1991).cast("int").alias("teu_count"),
        (day_start(t0) + days(F.lit(1))).alias("_loaded_at"))


CARRIER_CODES = ["maersk", "msc", "evergreen", "one", "hmm", "zim"]
SHIP_CARGO = ["Electronics", "Machinery", "Textiles", "Food", "Chemicals"]


def shipments(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """``raw_shipments``: one shipment per order (orders x customer)."""
    k = F.col("o_orderkey")
    carrier = F.lit("unlisted")
    for i in reversed(range(len(CARRIER_CODES))):
        carrier = F.when(F.col("o_custkey") % 7 == i, CARRIER_CODES[i]).otherwise(carrier)
    cargo = F.lit("Other")
    for i in reversed(range(len(SHIP_CARGO))):
        cargo = F.when(k % 6 == i, SHIP_CARGO[i]).otherwise(cargo)
    etd = F.col("o_orderdate") + year_shift()
    eta = etd + days(3 + k % 23)
    ata = (F.when(k % 20 == 0, F.lit(None).cast("timestamp_ntz"))
           .when(k % 20 == 1, eta - hours(F.lit(5)))
           .when(k % 10 < 6, eta)
           .otherwise(eta + hours(24 + k % 97)))
    value = F.col("o_totalprice").cast("decimal(15,2)")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .select(F.concat(F.lit("S"), _s(k)).alias("shipment_id"),
                    F.concat(F.lit("BL"), _s(100000 + k % 900000)).alias("bl_number"),
                    F.concat(F.lit("org"), _s(F.col("c_nationkey"))).alias("origin_port"),
                    F.concat(F.lit("nation_"), _s(k % 26)).alias("dest_port"),
                    carrier.alias("carrier_code"),
                    F.concat(F.lit("imo"), _s(9000001 + F.col("o_custkey") % 150)).alias("vessel_imo"),
                    etd.alias("etd"), eta.alias("eta"), ata.alias("ata"),
                    cargo.alias("cargo_type"),
                    F.concat(F.lit("Brand#"), _s(1 + k % 27)).alias("commodity_code"),
                    value.alias("declared_value_usd"),
                    F.round(value * D("0.08"), 2).cast("decimal(15,2)").alias("freight_usd"),
                    F.round(value * D("0.005"), 2).cast("decimal(15,2)").alias("insurance_usd"),
                    (etd + days(F.lit(1))).alias("_loaded_at")))


RATE_BY_PART = [0, 3, 5, 7, 10, 15]


def customs_entries(lineitem: DataFrame) -> DataFrame:
    """``raw_customs_entries``: one entry per line item."""
    pk, sk, ok = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    rate = F.lit(RATE_BY_PART[-1])
    for i in reversed(range(len(RATE_BY_PART) - 1)):
        rate = F.when(pk % 6 == i, RATE_BY_PART[i]).otherwise(rate)
    v = F.col("l_extendedprice").cast("decimal(15,2)")
    r = rate.cast("decimal(5,2)")
    du = F.round(v * r * D("0.01"), 2).cast("decimal(15,2)")
    lodge = F.col("l_shipdate") + year_shift()
    vat = F.round(F.when(pk % 50 == 0, v * D("0.12")).otherwise((v + du) * D("0.12")), 2) \
        .cast("decimal(15,2)")
    base = lineitem.select(
        F.concat(F.lit("CE"), _s(ok), F.lit("-"), _s(F.col("l_linenumber"))).alias("entry_number"),
        F.concat(F.lit("S"), _s(ok)).alias("shipment_id"),
        F.concat(F.lit("BL"), _s(100000 + ok % 900000)).alias("bl_number"),
        F.concat(F.lit(" brand#"), _s(1 + pk % 27)).alias("commodity_code"),
        F.when(F.col("l_returnflag") == "A", "formal ")
        .when(F.col("l_returnflag") == "N", "informal")
        .otherwise("warehousing").alias("entry_type"),
        v.alias("declared_value_usd"), r.alias("tariff_rate_pct"), du.alias("duties_usd"),
        vat.alias("vat_usd"),
        F.to_date(lodge).alias("lodge_date"),
        F.to_date(lodge + days(1 + pk % 5)).alias("assessment_date"),
        F.to_date(lodge + days(1 + pk % 5 + sk % 4)).alias("release_date"),
        F.when(pk % 11 == 0, F.lit(None)).otherwise(1 + pk % 5 + sk % 4).cast("int")
        .alias("processing_days"),
        F.when(F.col("l_linestatus") == "O", "cash").otherwise(" deferred ").alias("payment_mode"),
        F.concat(F.lit(" nation_"), _s(ok % 26)).alias("port_code"),
        (lodge + days(F.lit(1))).alias("_loaded_at"))
    return base.select(
        "entry_number", "shipment_id", "bl_number", "commodity_code", "entry_type",
        "declared_value_usd", "tariff_rate_pct", "duties_usd", "vat_usd",
        (F.col("duties_usd") + F.col("vat_usd")).cast("decimal(15,2)").alias("total_tax_usd"),
        "lodge_date", "assessment_date", "release_date", "processing_days",
        "payment_mode", "port_code", "_loaded_at")


def tariff_rates(part: DataFrame) -> DataFrame:
    """``ph_tariff_rates`` seed: one commodity code per part brand."""
    return (part.groupBy("p_brand").agg(F.max("p_size").alias("m"))
            .select(F.col("p_brand").alias("commodity_code"),
                    F.concat(F.lit("Goods "), F.col("p_brand")).alias("description"),
                    (F.col("m") % 16).cast("decimal(5,2)").alias("mfn_rate_pct"),
                    (F.col("m") % 6).cast("decimal(5,2)").alias("atiga_rate_pct")))


def fx_rates(orders: DataFrame) -> DataFrame:
    """``usd_php_rates`` seed: a close rate on each order date, with gaps."""
    d = F.to_date(F.col("o_orderdate") + year_shift())
    dates = orders.select(d.alias("rate_date")).distinct()
    return (dates.filter(F.dayofyear("rate_date") % 7 != 0)
            .select("rate_date",
                    (F.lit(50) + ((F.dayofyear("rate_date") * 37) % 1000) * D("0.01"))
                    .cast("decimal(8,4)").alias("usd_php_close")))


def metering_log(events: DataFrame) -> DataFrame:
    """Metering log (usage by group and interval) re-aimed on ``events``."""
    return events.select(F.col("ts").alias("start_time"),
                         F.upper(F.col("event_type")).alias("group_name"),
                         F.when(F.col("event_type") == "error", F.lit(0.0))
                         .otherwise(F.col("value")).alias("credits_used"))


def query_log(events: DataFrame) -> DataFrame:
    """Query log re-aimed on ``events``: value = elapsed seconds, k = partitions."""
    eid = F.col("event_id")
    parts = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.concat(F.lit("q"), _s(eid)).alias("query_id"),
        F.concat(F.lit("SELECT /* "), F.col("event_type"), F.lit(" */ * FROM t"), _s(eid % 13),
                 F.lit(" WHERE user_id = "), _s(F.col("user_id"))).alias("query_text"),
        F.upper(F.col("event_type")).alias("group_name"),
        (F.col("value") * 1000).cast("long").alias("total_elapsed_ms"),
        (F.col("value") * 100).cast("long").alias("compilation_ms"),
        (F.col("value") * 900).cast("long").alias("execution_ms"),
        (eid * 4096 + F.col("user_id")).alias("bytes_scanned"),
        (eid % 1000).alias("rows_produced"),
        parts.alias("partitions_scanned"),
        F.lit(100).cast("long").alias("partitions_total"),
        F.col("ts").alias("start_time"))


def refresh_log(events: DataFrame) -> DataFrame:
    """Refresh log of the two live tables, re-aimed on ``events``."""
    return events.select(
        F.when(F.col("event_id") % 2 == 0, "DT_ACTIVE_SHIPMENTS")
        .otherwise("DT_PORT_CONGESTION").alias("table_name"),
        F.col("ts").alias("start_time"),
        (F.col("value") * 0.001).alias("credits_used"))


@dataclass
class Bronze:
    """The derived domain inputs of one scale factor."""

    raw_vessel_calls: DataFrame
    raw_shipments: DataFrame
    raw_customs_entries: DataFrame
    ph_ports: DataFrame
    ph_tariff_rates: DataFrame
    usd_php_rates: DataFrame
    metering: DataFrame
    queries: DataFrame
    refreshes: DataFrame
    source: dict = field(default_factory=dict)


def load_bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    t = {n: read_table(spark, sf_dir, n) for n in TABLES}
    return Bronze(
        raw_vessel_calls=vessel_calls(t["events"]),
        raw_shipments=shipments(t["orders"], t["customer"]),
        raw_customs_entries=customs_entries(t["lineitem"]),
        ph_ports=ports(t["nation"], t["region"]),
        ph_tariff_rates=tariff_rates(t["part"]),
        usd_php_rates=fx_rates(t["orders"]),
        metering=metering_log(t["events"]),
        queries=query_log(t["events"]),
        refreshes=refresh_log(t["events"]),
        source=t,
    )
