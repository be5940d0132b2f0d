"""Gold facts (survey J10-J12).

Dimension joins: the calendar and the port seed are broadcast behind a size
check; the small data-derived dimensions (vessel, carrier) arrive already
materialised and size-checked (``Warehouse``); the shipment dimension, as
large as the fact, is a shuffle join on the id, reduced to one row per id
first.  Only the columns a fact needs are taken from each dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domain as d
from ..functions.scalars import ts_key_text
from ..operators.asof import attach_daily_rate
from ..operators.broadcast import checked_broadcast
from .dims import CALENDAR_ROWS


def _dates(dim_date: DataFrame, name: str) -> DataFrame:
    return checked_broadcast(dim_date.select(F.col("date_key").alias(name)),
                             known_rows=CALENDAR_ROWS)


def dwell_key(vessel_imo, berth_ts, arrival_ts, null_safe: bool = True):
    """``MD5(imo || CAST(berth_ts AS VARCHAR))``; with ``null_safe`` a missing
    berth time falls back to the arrival time so the key is never NULL (Z11)."""
    ts = F.coalesce(F.col(berth_ts), F.col(arrival_ts)) if null_safe else F.col(berth_ts)
    return F.md5(F.concat(F.col(vessel_imo), ts_key_text(ts)))


def fct_port_dwell(calls: DataFrame, dim_vessel: DataFrame, dim_date: DataFrame,
                   dim_port_b: DataFrame) -> DataFrame:
    """One row per staged vessel call."""
    v = calls.withColumn("__arr_date", F.to_date("arrival_ts"))
    vd = dim_vessel.select("vessel_imo", "vessel_key")
    dd = _dates(dim_date, "__date_key")
    p = dim_port_b.select("port_code", "port_key", F.col("cell_res5").alias("port_cell_res5"))
    j = (v.join(vd, "vessel_imo", "left")
         .join(dd, v["__arr_date"] == dd["__date_key"], "left")
         .join(p, "port_code", "left"))
    return j.select(dwell_key("vessel_imo", "berth_ts", "arrival_ts").alias("dwell_key"),
                    "vessel_imo", "vessel_key",
                    F.col("__date_key").alias("arrival_date_key"),
                    "port_key", "berth_ts", "cargo_type", "dwell_hours", "anchorage_wait_h",
                    "teu_count", "port_cell_res5",
                    d.is_congested("anchorage_wait_h").alias("is_congested"),
                    "_loaded_at")


def fct_shipment_events(shipments: DataFrame, dim_shipment: DataFrame | None, dim_date: DataFrame,
                        dim_port_b: DataFrame, dim_carrier: DataFrame | None) -> DataFrame:
    """One row per staged shipment; date x3 and port x2 role-playing.

    A run over a part of the feed gives None for the shipment and carrier dimensions:
    they hold every staged id and code, these rows' own included, so the keys follow
    from the rows themselves, also for ids that the stored dimensions do not know yet."""
    s = shipments.select("*", F.to_date("etd").alias("__etd_d"), F.to_date("eta").alias("__eta_d"),
                         F.to_date("ata").alias("__ata_d"))
    de, da, dt_ = (_dates(dim_date, n) for n in ("etd_date_key", "eta_date_key", "ata_date_key"))
    po = dim_port_b.select(F.col("port_code").alias("__po"), F.col("port_key").alias("origin_port_key"))
    pd_ = dim_port_b.select(F.col("port_code").alias("__pd"), F.col("port_key").alias("dest_port_key"))
    if dim_shipment is None:
        keyed = s.withColumn("shipment_key", F.md5("shipment_id"))
    else:
        # The dimension's key is MD5(id): the join only has to say whether the id
        # exists there.  Distinct ids (a hash aggregate partitioned like the join)
        # keep duplicated ids from fanning out; the key is then derived.
        sh = dim_shipment.select(F.col("shipment_id").alias("__sid")).distinct()
        keyed = (s.join(sh, s["shipment_id"] == sh["__sid"], "left")
                 .withColumn("shipment_key", F.when(F.col("__sid").isNotNull(), F.md5("shipment_id"))))
    j = (keyed.join(de, s["__etd_d"] == de["etd_date_key"], "left")
         .join(da, s["__eta_d"] == da["eta_date_key"], "left")
         .join(dt_, s["__ata_d"] == dt_["ata_date_key"], "left")
         .join(po, s["origin_port_code"] == po["__po"], "left")
         .join(pd_, s["dest_port_code"] == pd_["__pd"], "left"))
    if dim_carrier is None:
        j = j.withColumn("carrier_key", F.md5("carrier_code"))
    else:
        j = j.join(dim_carrier.select("carrier_code", "carrier_key"), "carrier_code", "left")
    return j.select("shipment_id", "shipment_key", "etd_date_key", "eta_date_key", "ata_date_key",
                    "origin_port_key", "dest_port_key", "carrier_key", "etd", "eta", "ata",
                    "delay_hours", "delay_category",
                    d.event_type("ata", "delay_hours", "delay_category").alias("event_type"),
                    "declared_value_usd", "freight_usd", "insurance_usd", "_loaded_at")


def fct_landed_cost(shipments: DataFrame, tariffs_b: DataFrame, fx_rates: DataFrame,
                    as_of_date, fx: str = "max_to_date") -> DataFrame:
    """CIF, duties, 12 % VAT and the PHP total per shipment.

    ``fx="max_to_date"`` reproduces the reference SQL (largest rate value on
    or before the ETA); ``fx="asof"`` is the forward-filled rate.  A shipment
    without ETA is priced on ``as_of_date``; without any earlier rate, 56.0.
    """
    duties = tariffs_b.select("commodity_code", F.col("mfn_rate_pct").alias("__rate"))
    s = shipments.join(duties, "commodity_code", "left")
    anchor = F.coalesce(F.to_date("eta"), F.lit(as_of_date).cast("date"))
    s = attach_daily_rate(s, anchor, fx_rates, "rate_date", "usd_php_close", "__fx", mode=fx)
    cif = F.col("declared_value_usd") + F.col("freight_usd") + F.col("insurance_usd")
    rate = F.coalesce(F.col("__rate"), F.lit(0).cast("decimal(5,2)"))
    usd_php = F.coalesce(F.col("__fx"), F.lit(d.DEFAULT_FX).cast("decimal(8,4)"))
    duties_usd = F.round(cif * rate * F.expr("0.01"), 2)
    vat_usd = F.round((cif + cif * rate * F.expr("0.01")) * F.expr("0.12"), 2)
    total = F.round(cif * (F.lit(1) + rate * F.expr("0.01")) * F.expr("1.12") * usd_php, 2)
    return s.select("shipment_id", "bl_number", "dest_port_code",
                    F.to_date("eta").alias("eta_date_key"),
                    "declared_value_usd", "freight_usd", "insurance_usd",
                    cif.cast("decimal(17,2)").alias("cif_usd"),
                    rate.cast("decimal(5,2)").alias("duty_rate_pct"),
                    duties_usd.cast("decimal(17,2)").alias("duties_usd"),
                    vat_usd.cast("decimal(17,2)").alias("vat_usd"),
                    total.cast("decimal(22,2)").alias("total_landed_cost_php"),
                    usd_php.cast("decimal(8,4)").alias("usd_php_rate"),
                    "_loaded_at")
