"""Edge rows of FIXTURES.md section 5, pushed through the model functions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from harborline.functions import domain as d
from harborline.functions.scalars import haversine_km, hours_between
from harborline.operators.asof import attach_daily_rate
from harborline.operators.incremental import upsert, watermark_filter, watermark_value
from harborline.plans import dims, facts, marts, staging

T = dt.datetime
SHIP_DDL = ("shipment_id string, bl_number string, origin_port string, dest_port string, carrier_code string, "
            "vessel_imo string, etd timestamp_ntz, eta timestamp_ntz, ata timestamp_ntz, cargo_type string, "
            "commodity_code string, declared_value_usd decimal(15,2), freight_usd decimal(15,2), "
            "insurance_usd decimal(15,2), _loaded_at timestamp_ntz")


def _ship(spark, rows):
    base = []
    for i, (eta, ata) in enumerate(rows):
        base.append((f"S{i}", "BL", "org", "mict", "msc", "imo1", T(2025, 12, 20), eta, ata, "Food", "C1",
                     Decimal("100.00"), Decimal("0.00"), Decimal("0.00"), T(2026, 1, 1)))
    return spark.createDataFrame(base, SHIP_DDL)


def test_delay_hours_and_bands(spark):
    eta = T(2026, 1, 1, 0, 59)
    rows = [(eta, T(2026, 1, 1, 1, 1)),          # 1: boundary count -> 1 h
            (eta, None),                          # 2: in transit
            (T(2026, 1, 1, 10), T(2026, 1, 1, 5)),  # 3: early arrival
            (T(2026, 1, 1), T(2026, 1, 1)),        # 4: 0
            (T(2026, 1, 1), T(2026, 1, 2)),        # 24
            (T(2026, 1, 1), T(2026, 1, 2, 1)),     # 25
            (T(2026, 1, 1), T(2026, 1, 4)),        # 72
            (T(2026, 1, 1), T(2026, 1, 4, 1))]     # 73
    s = staging.stg_shipments(_ship(spark, rows))
    s = s.withColumn("ev", d.event_type("ata", "delay_hours", "delay_category"))
    got = [(r.delay_hours, r.delay_category, r.ev) for r in s.orderBy(F.length("shipment_id"), "shipment_id").collect()]
    assert got == [
        (1, "MINOR_DELAY", "ARRIVED_MINOR_DELAY"),
        (None, "SEVERE_DELAY", "IN_TRANSIT"),
        (0, "MINOR_DELAY", "ARRIVED_ON_TIME"),
        (0, "ON_TIME", "ARRIVED_ON_TIME"),
        (24, "MINOR_DELAY", "ARRIVED_MINOR_DELAY"),
        (25, "MODERATE_DELAY", "ARRIVED_MODERATE_DELAY"),
        (72, "MODERATE_DELAY", "ARRIVED_MODERATE_DELAY"),
        (73, "SEVERE_DELAY", "ARRIVED_SEVERE_DELAY")]
    # prose reading: clamped band puts the early arrival on time
    c = staging.stg_shipments(_ship(spark, rows[2:3]), clamp_category=True).first()
    assert c.delay_category == "ON_TIME"


def test_elapsed_vs_boundary_hours(spark):
    df = spark.createDataFrame([(T(2026, 1, 1, 0, 59), T(2026, 1, 1, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(hours_between("a", "b").alias("x"), hours_between("a", "b", "elapsed").alias("y")).first()
    assert (r.x, r.y) == (1, 0)


def test_flags_levels_bands(spark):
    df = spark.createDataFrame([(24,), (25,), (None,)], "w int")
    assert [r[0] for r in df.select(d.is_congested("w")).collect()] == [False, True, False]
    lv = spark.createDataFrame([(60.0,), (59.9,), (35.0,), (15.0,), (14.9,), (None,)], "r double")
    assert [r[0] for r in lv.select(d.congestion_level(F.col("r"))).collect()] == \
        ["CRITICAL", "HIGH", "HIGH", "MODERATE", "NORMAL", "NORMAL"]
    pdays = spark.createDataFrame([(2,), (5,), (6,), (10,), (11,), (None,)], "p int")
    got = [(r[0], r[1]) for r in pdays.select(d.clearance_band(F.col("p")), d.is_sla_breach(F.col("p"))).collect()]
    assert got == [("FAST", False), ("STANDARD", False), ("SLOW", True), ("SLOW", True),
                   ("CRITICAL", True), ("CRITICAL", False)]


CALL_DDL = ("vessel_imo string, port_code string, arrival_ts timestamp_ntz, berth_ts timestamp_ntz, "
            "departure_ts timestamp_ntz, dwell_hours int, anchorage_wait_h int, cargo_type string, "
            "teu_count int, _loaded_at timestamp_ntz")


def test_dwell_repair_and_trim(spark):
    a = T(2026, 1, 1)
    rows = [("V1", " mict ", a, a, a + dt.timedelta(hours=30), None, 0, "fcl", 10, a),   # repaired -> 30
            ("V2", "MICT", a, a, a + dt.timedelta(hours=5), 0, 0, "fcl", 10, a),         # 0 -> dropped
            ("V3", "MICT", None, a, a + dt.timedelta(hours=5), 5, 0, "fcl", 10, a)]      # no arrival
    s = staging.stg_vessel_calls(spark.createDataFrame(rows, CALL_DDL)).collect()
    assert [(r.vessel_imo, r.port_code, r.dwell_hours, r.cargo_type) for r in s] == [("V1", "MICT", 30, "FCL")]


def test_vessel_type_alphabetical(spark):
    a = T(2026, 1, 1)
    rows = [("V1", "P", a, a, a, 5, 0, c, 1, a) for c in ["FCL"] * 9 + ["BULK"]]
    v = dims.dim_vessel(spark.createDataFrame(rows, CALL_DDL)).first()
    assert v.vessel_type == "BULK"


def test_null_berth_key_is_stable(spark):
    a = T(2026, 1, 1)
    df = spark.createDataFrame([("V1", None, a)], "vessel_imo string, berth_ts timestamp_ntz, arrival_ts timestamp_ntz")
    k = df.select(facts.dwell_key("vessel_imo", "berth_ts", "arrival_ts").alias("k")).first().k
    assert k is not None


def test_fx_modes_and_default(spark):
    rates = spark.createDataFrame([(dt.date(2026, 1, 1), Decimal("56.1000")), (dt.date(2026, 1, 2), Decimal("55.9000"))],
                                  "rate_date date, usd_php_close decimal(8,4)")
    f = spark.createDataFrame([(dt.date(2026, 1, 3),), (dt.date(2025, 12, 1),), (dt.date(2026, 1, 2),)], "d date")
    m = {r.d: r.x for r in attach_daily_rate(f, F.col("d"), rates, "rate_date", "usd_php_close", "x").collect()}
    a = {r.d: r.x for r in attach_daily_rate(f, F.col("d"), rates, "rate_date", "usd_php_close", "x", "asof").collect()}
    assert m[dt.date(2026, 1, 3)] == Decimal("56.1000") and a[dt.date(2026, 1, 3)] == Decimal("55.9000")
    assert m[dt.date(2025, 12, 1)] is None and a[dt.date(2026, 1, 2)] == Decimal("55.9000")


def test_landed_cost_arithmetic_and_defaults(spark):
    s = _ship(spark, [(T(2026, 1, 3), T(2026, 1, 3)), (T(2025, 1, 1), T(2025, 1, 1))])
    s = staging.stg_shipments(s)
    tariffs = spark.createDataFrame([("C1", "x", Decimal("5.00"), Decimal("0.00"))],
                                    "commodity_code string, description string, mfn_rate_pct decimal(5,2), "
                                    "atiga_rate_pct decimal(5,2)")
    rates = spark.createDataFrame([(dt.date(2026, 1, 1), Decimal("56.0000"))], "rate_date date, usd_php_close decimal(8,4)")
    lc = {r.shipment_id: r for r in facts.fct_landed_cost(s, tariffs, rates, dt.date(2026, 2, 1)).collect()}
    r = lc["S0"]
    assert (r.duties_usd, r.vat_usd, r.total_landed_cost_php) == (Decimal("5.00"), Decimal("12.60"), Decimal("6585.60"))
    assert lc["S1"].usd_php_rate == Decimal("56.0000")          # ETA before the first rate -> 56.0
    no_tariff = facts.fct_landed_cost(s.withColumn("commodity_code", F.lit("ZZ")), tariffs, rates,
                                      dt.date(2026, 2, 1)).first()
    assert no_tariff.duty_rate_pct == Decimal("0.00")


def test_rolling_is_rows_not_days(spark):
    ports = spark.createDataFrame([("pk", "P", "n", "r", "t")], "port_key string, port_code string, port_name string, "
                                  "region string, port_type string")
    cal = dims.dim_date(spark)
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=3 * i) for i in range(10)]
    f = spark.createDataFrame([("pk", dd, 1, i + 1, 0, False) for i, dd in enumerate(days)],
                              "port_key string, arrival_date_key date, teu_count int, dwell_hours long, "
                              "anchorage_wait_h int, is_congested boolean")
    out = marts.port_throughput_daily(f, ports, cal).orderBy("report_date").collect()
    assert out[-1].rolling_7d_avg_dwell_hours == 7.0        # mean of 4..10 (7 rows over 19 days)
    assert out[0].rolling_7d_avg_dwell_hours == 1.0


def test_upsert_latest_wins_and_strict_watermark(spark):
    ddl = "k string, v int, _loaded_at timestamp_ntz"
    tgt = spark.createDataFrame([("a", 1, T(2026, 1, 1)), ("b", 1, T(2026, 1, 2))], ddl)
    delta = spark.createDataFrame([("b", 2, T(2026, 1, 3)), ("b", 3, T(2026, 1, 4)), ("c", 1, T(2026, 1, 3))], ddl)
    out = {r.k: r.v for r in upsert(tgt, delta, ["k"]).collect()}
    assert out == {"a": 1, "b": 3, "c": 1}
    src = spark.createDataFrame([("x", 1, T(2026, 1, 2)), ("y", 1, T(2026, 1, 5))], ddl)
    mx = watermark_value(tgt, "_loaded_at")
    assert [r.k for r in watermark_filter(src, "_loaded_at", mx).collect()] == ["y"]   # equal ts skipped
    assert sorted(r.k for r in watermark_filter(src, "_loaded_at", mx, dt.timedelta(days=1)).collect()) == ["x", "y"]
    empty = tgt.limit(0)
    assert watermark_filter(src, "_loaded_at", watermark_value(empty, "_loaded_at")).count() == 0


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0)], "a long, b long")
    assert df.select(marts.pct_of(F.col("a"), F.col("b")).alias("x")).first().x is None


def test_distance_bounds(spark):
    df = spark.createDataFrame([(10.0, 120.0, 10.0, 120.0), (10.0, 120.0, 10.0 + 200.1 / 111.19508, 120.0)],
                               "a double, b double, c double, e double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "e")).collect()]
    assert got[0] == 0.0 and 200.0 < got[1] < 200.2


def test_spatial_join_matches_brute_force(spark):
    import math
    import random
    rnd = random.Random(7)
    pts = [(f"p{i}", rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(150)]
    pts += [("q1", 10.0, 179.9), ("q2", 10.0, -179.9), ("q3", 89.5, 0.0), ("q4", 89.6, 120.0)]
    df = spark.createDataFrame(pts, "id string, lat double, lon double")
    from harborline.operators.spatial import pairs_within
    got = {(r.id_a, r.id_b) for r in pairs_within(df, "id", "lat", "lon", 500.0).collect()}

    def hav(a, b):
        la1, lo1, la2, lo2 = map(math.radians, (a[1], a[2], b[1], b[2]))
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
        return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h)))
    want = {(a[0], b[0]) for a in pts for b in pts if a[0] != b[0] and hav(a, b) <= 500.0}
    assert got == want and ("q1", "q2") in got and ("q3", "q4") in got


def test_duplicated_dimension_key_does_not_fan_out(spark):
    from harborline.plans import dims as dm
    T2 = dt.datetime
    rows = [(T2(2026, 1, 1), T2(2026, 1, 1))] * 50
    s = staging.stg_shipments(_ship(spark, rows).withColumn("shipment_id", F.lit("HOT")))
    ports = spark.createDataFrame([("MICT", "Port of MICT", "r", "domestic", 10.0, 120.0)],
                                  "port_code string, port_name string, region string, port_type string, "
                                  "lat double, lon double")
    f = facts.fct_shipment_events(s, dm.dim_shipment(s), dm.dim_date(spark), dm.dim_port(ports),
                                  dm.dim_carrier(s))
    assert f.count() == 50                      # the fact keeps its grain, not 50 x 50


def test_distributed_exact_percentile_matches_numpy(spark):
    import numpy as np

    from harborline.operators.percentile import exact_percentiles
    rng = np.random.default_rng(3)
    rows = [("hot", float(x)) for x in rng.normal(100, 30, 3000).round(3)]        # one hot group
    rows += [(f"g{i % 7}", float(x)) for i, x in enumerate(rng.exponential(50, 400).round(2))]
    rows += [("hot", None), (None, 5.0), (None, 7.0), ("single", 42.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.p50, r.p90) for r in exact_percentiles(df, ["k"], "v", {"p50": 0.5, "p90": 0.9},
                                                            partitions=8).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    for k, vals in groups.items():
        want = (round(float(np.percentile(vals, 50)), 6), round(float(np.percentile(vals, 90)), 6))
        assert got[k] == pytest.approx(want, abs=2e-6), k


def test_null_berth_call_processed_twice_is_one_row(spark):
    """Fixture 19: the null-safe dwell key makes the re-run replace, not add."""
    a = T(2026, 1, 1)
    rows = [("V1", "MICT", a, None, a + dt.timedelta(hours=30), 30, 0, "FCL", 10, a)]
    calls = staging.stg_vessel_calls(spark.createDataFrame(rows, CALL_DDL))
    keyed = calls.select(facts.dwell_key("vessel_imo", "berth_ts", "arrival_ts").alias("dwell_key"), "_loaded_at")
    once = upsert(keyed.limit(0), keyed, ["dwell_key"])
    twice = upsert(once, keyed, ["dwell_key"])
    assert twice.count() == 1


def test_ports_zero_and_just_over_radius(spark):
    """Fixture 24: two distinct ports 0 km apart are a pair; 200.1 km apart are not."""
    from harborline.operators.spatial import KM_PER_DEG, pairs_within
    pts = spark.createDataFrame([("a", 10.0, 120.0), ("b", 10.0, 120.0), ("c", 10.0 + 200.1 / KM_PER_DEG, 120.0)],
                                "id string, lat double, lon double")
    got = {(r.id_a, r.id_b): r.distance_km for r in pairs_within(pts, "id", "lat", "lon", 200.0).collect()}
    assert got == {("a", "b"): 0.0, ("b", "a"): 0.0}
