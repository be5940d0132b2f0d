"""Live tables: panes, late rows, unknown ports, keys of new shipments, refresh log."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from harborline.operators.panes import pane_of, pane_start, sliding_sums
from harborline.plans import live
from harborline.registry import warehouse
from harborline.sources import schemas
from harborline.streaming import live as sl
from harborline.streaming import live_run
from harborline.streaming import refresh_log as rl

from .conftest import SF_SMALL
from .test_oracle import _rows

T = dt.datetime


def _dirs():
    root = tempfile.mkdtemp()
    return f"{root}/src", f"{root}/state", f"{root}/ckpt"


@pytest.mark.parametrize("name", ["stream_port_congestion", "stream_unknown_ports", "stream_late_calls", "stream_lag"])
def test_stream_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    res = duck.sql(oracle_sql()[name])
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), res.columns)


def test_sliding_sums_equal_brute_force(spark):
    panes = [("p", 3, 2, 5), ("p", 4, 1, 0), ("p", 10, 1, 7), ("q", -2, 4, 1)]
    got = {(r.k, r.window): (r.n, r.w) for r in sliding_sums(
        spark.createDataFrame(panes, "k string, pane long, n long, w long"), ["k"], ["n", "w"], 4).collect()}
    want = {}
    for k, pane, n, w in panes:
        for first in range(pane - 3, pane + 1):
            a, b = want.get((k, first), (0, 0))
            want[k, first] = (a + n, b + w)
    assert got == want


def test_panes_of_times(spark):
    times = [T(1969, 12, 31, 23, 59), T(1970, 1, 1), T(2026, 3, 29, 2, 14, 59), T(2026, 3, 29, 2, 15)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = [r[0] for r in df.select(pane_start(pane_of(F.col("t"), 15), 15)).collect()]
    assert got == [T(1969, 12, 31, 23, 45), T(1970, 1, 1), T(2026, 3, 29, 2, 0), T(2026, 3, 29, 2, 15)]


def _call(ts, wait=0, port="nation_1"):
    return ("IMO1", port, ts, ts, None, 5, wait, "FCL", 10, T(2026, 1, 9))


def test_late_calls_count_in_their_windows(spark):
    wh, (src, state, ckpt) = warehouse(spark, SF_SMALL), _dirs()

    def deliver(*calls):
        spark.createDataFrame(list(calls), schemas.RAW_VESSEL_CALLS).coalesce(1).write.mode("append").parquet(src)
        return sl.stream_port_congestion(spark, src, state, ckpt, wh.dim_port_b)[1]
    deliver(_call(T(2026, 1, 5, 12)))
    windows = deliver(_call(T(2026, 1, 1, 12), wait=30), _call(T(2026, 1, 5, 11)))
    log = sl.pane_log(spark, state)
    assert log.read_sums().agg(F.sum("late_calls"), F.sum("vessels_in_port")).first()[:] == (1, 3)
    by_start = {r.window_start: r for r in windows().collect()}
    assert by_start[T(2026, 1, 1, 12)].congestion_pct == 100.0 and len(by_start) == 96 + 100
    before = sorted(map(tuple, windows().collect()))
    assert log.compact_sums() == 1
    assert sorted(map(tuple, windows().collect())) == before


def _shipment(i, dest="nation_1", carrier="msc"):
    return (i, "BL", "org", dest, carrier, "imo", T(2026, 1, 1), T(2026, 1, 5), None, "Food", "C",
            Decimal("1.00"), Decimal("0.00"), Decimal("0.00"), T(2026, 1, 2))


def test_unknown_ports_are_labelled_and_counted(spark):
    wh, (src, state, ckpt) = warehouse(spark, SF_SMALL), _dirs()
    spark.createDataFrame([_shipment("S1"), _shipment("S2", "atlantis"), _shipment("S3", None)],
                          schemas.RAW_SHIPMENTS).write.parquet(src)
    _, table = sl.stream_active_shipments(spark, src, state, ckpt, wh.dim_port_b, wh.as_of)
    names = {r.shipment_id: r.dest_port_name for r in table().collect()}
    assert names.pop("S1") is not None and names == {"S2": None, "S3": None}
    unknown = live.unknown_ports(sl.latest_shipments(spark, state))
    assert sorted(map(tuple, unknown.collect()), key=str) == [("ATLANTIS", "UNKNOWN PORT", 1), (None, "UNKNOWN PORT", 1)]


def test_shipment_unknown_at_start_has_its_keys(spark):
    wh, (src, state, ckpt) = warehouse(spark, SF_SMALL), _dirs()
    spark.createDataFrame([_shipment("NEW-1", carrier="brandnew")], schemas.RAW_SHIPMENTS).write.parquet(src)
    _, table = sl.stream_fact_upsert(spark, src, state, ckpt, wh)
    import hashlib
    row = table().first()
    assert row.shipment_key == hashlib.md5(b"NEW-1").hexdigest() and row.carrier_key == hashlib.md5(b"BRANDNEW").hexdigest()


def test_refresh_log_counts_late_rows_and_outlives_a_restart(spark):
    src, out, ckpt = _dirs()
    log = os.path.join(tempfile.mkdtemp(), "log")

    def deliver(*ids_and_days):
        rows = [_shipment(i)[:-1] + (day,) for i, day in ids_and_days]
        spark.createDataFrame(rows, schemas.RAW_SHIPMENTS).coalesce(1).write.mode("append").parquet(src)
        with rl.RefreshLog(spark, log) as listener:
            q, _ = sl.stream_dedup(spark, src, out, ckpt, delay="10 days")
            listener.wait(q)
    deliver(("a", T(2026, 1, 1)), ("b", T(2026, 3, 1)))
    deliver(("c", T(2026, 3, 2)))
    deliver(("d", T(2026, 1, 1)), ("e", T(2026, 3, 3)))     # d is far behind the watermark
    seen = rl.read_log(spark, log)
    lag = {r.query_name: r for r in rl.refresh_lag(seen, {"raw_shipments_dedup": 5.0, "never_started": 1.0},
                                                   dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).collect()}
    done = lag["raw_shipments_dedup"]
    assert (done.input_rows, done.late_rows_dropped, done.batches, done.lag_status) == (5, 1, 3, "OK")
    assert (lag["never_started"].batches, lag["never_started"].lag_status) == (0, "LAGGING")
    later = rl.refresh_lag(seen, {"raw_shipments_dedup": 5.0}, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
                           + dt.timedelta(hours=1)).first()
    assert later.lag_status == "LAGGING" and later.minutes_since_refresh >= 59
    assert seen.select("run_id").distinct().count() == 3 and seen.select("query_id").distinct().count() == 1
    assert rl.refresh_cost(seen).agg(F.sum("input_rows")).first()[0] == 5
    assert rl.read_log(spark, log + "-none").count() == 0


def test_live_run_drains_and_reports(spark):
    wh = warehouse(spark, SF_SMALL)
    root = tempfile.mkdtemp()
    for name in ("raw_shipments", "raw_vessel_calls"):
        getattr(wh, name).write.parquet(f"{root}/bronze/{name}")
    wh.bronze.ph_ports.write.parquet(f"{root}/bronze/ph_ports")
    for _ in range(2):      # the second run finds nothing new
        started, lag = live_run.start(spark, f"{root}/bronze", f"{root}/state", once=True)
        report = {r.query_name: r for r in lag.collect()}
        assert {n: (r.input_rows, r.lag_status) for n, r in report.items()} == {
            "dt_active_shipments": (wh.raw_shipments.count(), "OK"), "dt_port_congestion": (wh.raw_vessel_calls.count(), "OK")}
