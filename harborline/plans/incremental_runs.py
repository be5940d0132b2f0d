"""Incremental runs of the facts, as queries (survey A13, A14, M5).

Each run writes real table versions under the cluster's shared checkpoint
folder (a fresh sub-folder per call) and returns the final version read back
from storage.  All three must equal the full refresh of the same model.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from ..functions.scalars import lit_ntz

from ..operators.incremental import (PartitionedTable, VersionedTable, run_incremental,
                                     run_incremental_mart, run_incremental_partitioned)
from ..operators.latest import latest_rows
from ..session import shared_dir
from . import facts, mart_runs, marts, staging

# Split of the shipment feed into "already loaded" and "arrived later".
FIRST_RUN_CUTOFF = dt.datetime(2026, 1, 1)
LATE_SHARE = 10          # 1 in LATE_SHARE shipments of the last month is delivered late
LATE_WINDOW = dt.timedelta(days=31)
MOVE_YEARS = 50


def _events_builder(wh):
    def build(raw: DataFrame) -> DataFrame:
        return facts.fct_shipment_events(staging.stg_shipments(raw, wh.clamp_category), None,
                                         wh.dim_date, wh.dim_port_b, None)
    return build


def _table(wh, name: str) -> VersionedTable:
    return VersionedTable(wh.spark, shared_dir(wh.spark, f"incremental/{name}-{uuid.uuid4().hex[:12]}"))


# The stored shipment fact is partitioned by departure month (yyyymm): new and
# updated shipments land in recent months, so an upsert rewrites few partitions.
PART_COL = "etd_month"


def _partitioned_builder(wh):
    base = _events_builder(wh)

    def build(raw: DataFrame) -> DataFrame:
        f = base(raw)
        return f.withColumn(PART_COL, (F.year("etd") * 100 + F.month("etd")).cast("int"))
    return build


def _ptable(wh, name: str) -> PartitionedTable:
    return PartitionedTable(wh.spark, shared_dir(wh.spark, f"incremental/{name}-{uuid.uuid4().hex[:12]}"),
                            PART_COL)


def incremental_upsert(wh) -> DataFrame:
    """First run on the feed up to the cutoff, second run on the whole feed:
    only rows past the watermark are modelled and upserted."""
    t = _ptable(wh, "fct_shipment_events")
    build = _partitioned_builder(wh)
    raw = wh.raw_shipments
    run_incremental_partitioned(t, build, raw.filter(F.col("_loaded_at") <= lit_ntz(FIRST_RUN_CUTOFF)),
                                ["shipment_id"])
    run_incremental_partitioned(t, build, raw, ["shipment_id"])
    return t.read().drop(PART_COL)


def incremental_full_refresh(wh) -> DataFrame:
    """A table that holds rows of another feed, rebuilt by a full refresh."""
    t = _ptable(wh, "fct_shipment_events_full")
    build = _partitioned_builder(wh)
    other = wh.raw_shipments.withColumn("shipment_id", F.concat(F.lit("OLD-"), F.col("shipment_id")))
    run_incremental_partitioned(t, build, other, ["shipment_id"])
    run_incremental_partitioned(t, build, wh.raw_shipments, ["shipment_id"], full_refresh=True)
    return t.read().drop(PART_COL)


def incremental_rerun_noop(wh) -> DataFrame:
    """A second run on the same feed finds nothing past the watermark."""
    t = _table(wh, "fct_shipment_events_rerun")
    build = _events_builder(wh)
    run_incremental(t, build, wh.raw_shipments, ["shipment_id"])
    run_incremental(t, build, wh.raw_shipments, ["shipment_id"])
    return t.read()


def late_rows_lookback(wh, strict: bool = False) -> DataFrame:
    """Late delivery: some rows of the month before the cutoff reach the feed
    only after the first run.  Strict ``>`` loses them (Z10); a lookback of
    the late window reprocesses them and the upsert makes the result whole."""
    t = _ptable(wh, "fct_shipment_events_late")
    build = _partitioned_builder(wh)
    raw = wh.raw_shipments
    cutoff = lit_ntz(FIRST_RUN_CUTOFF)
    late = ((F.col("_loaded_at") > cutoff - F.expr(f"INTERVAL {LATE_WINDOW.days} DAYS"))
            & (F.col("_loaded_at") <= cutoff) & (F.abs(F.xxhash64("shipment_id")) % LATE_SHARE == 0))
    run_incremental_partitioned(t, build, raw.filter((F.col("_loaded_at") <= cutoff) & ~late), ["shipment_id"])
    # the second run sees the append-only feed, now holding the late rows too
    run_incremental_partitioned(t, build, raw, ["shipment_id"], lookback=None if strict else LATE_WINDOW)
    return t.read().drop(PART_COL)


def incremental_key_move(wh) -> DataFrame:
    """Shipments past the cutoff are first loaded with a departure ``MOVE_YEARS``
    too late, in months that hold nothing else; their correction moves them
    back and leaves those months empty."""
    t = _ptable(wh, "fct_shipment_events_move")
    build = _partitioned_builder(wh)
    raw = wh.raw_shipments
    past = F.col("_loaded_at") > lit_ntz(FIRST_RUN_CUTOFF)
    wrong = raw.withColumns({
        "etd": F.when(past, F.col("etd") + F.make_ym_interval(F.lit(MOVE_YEARS))).otherwise(F.col("etd")),
        "_loaded_at": F.least("_loaded_at", lit_ntz(FIRST_RUN_CUTOFF))})
    run_incremental_partitioned(t, build, wrong, ["shipment_id"])
    run_incremental_partitioned(t, build, raw, ["shipment_id"])
    return t.read().drop(PART_COL)


def throughput_incremental(wh) -> DataFrame:
    """Daily port throughput in two runs, split at the middle of the arrivals."""
    t = _table(wh, "port_throughput_daily")
    fpd = wh.fct_port_dwell
    cut = fpd.agg(F.percentile_approx("arrival_date_key", 0.5)).first()[0]
    for seen in (fpd.filter(F.col("arrival_date_key") <= F.lit(cut)), fpd):
        run_incremental_mart(
            t, lambda after, cur: marts.port_throughput_daily(seen, wh.dim_port_b, wh.dim_date_b, after, cur),
            "report_date", ["port_code", "report_date"])
    return t.read()


def _dwell_builder(wh):
    def build(raw: DataFrame) -> DataFrame:
        f = facts.fct_port_dwell(staging.stg_vessel_calls(raw), wh.dim_vessel_b, wh.dim_date, wh.dim_port_b)
        return f.withColumn(mart_runs.ARRIVAL_MONTH, mart_runs.month_of("arrival_date_key"))
    return build


def _two_deliveries(raw: DataFrame, id_cols: list[str], moved: str) -> tuple[DataFrame, dt.timedelta]:
    """The first delivery of a feed, whose last tenth has not come yet: of the tenth before,
    one row in ten is held back, another one in ten bears a ``moved`` time two weeks
    late.  With it, how far the second run has to look back."""
    oldest, newest = raw.agg(F.min("_loaded_at"), F.max("_loaded_at")).first()
    tenth = (newest - oldest) / 10
    share = F.pmod(F.xxhash64(*id_cols), F.lit(LATE_SHARE))
    recent = F.col("_loaded_at") > lit_ntz(newest - 2 * tenth)
    first = raw.filter((F.col("_loaded_at") <= lit_ntz(newest - tenth)) & ~(recent & (share == 0)))
    wrong = F.when(recent & (share == 1), F.col(moved) + F.expr("INTERVAL 14 DAYS")).otherwise(F.col(moved))
    return first.withColumn(moved, wrong), tenth + dt.timedelta(days=1)


def _facts_in_two_runs(wh, after_each) -> None:
    """Both facts loaded by a first delivery and by the whole feed; ``after_each(dwell,
    events)`` runs after either."""
    events = _ptable(wh, "events_late")
    dwell = PartitionedTable(wh.spark, shared_dir(wh.spark, f"incremental/dwell_late-{uuid.uuid4().hex[:12]}"),
                             mart_runs.ARRIVAL_MONTH)
    first_events, back_events = _two_deliveries(wh.raw_shipments, ["shipment_id"], "eta")
    # a call's key holds its berth time: only rows held back, none moved
    first_dwell, back_dwell = _two_deliveries(wh.raw_vessel_calls, ["vessel_imo", "berth_ts"], "departure_ts")
    for calls, shipments in ((first_dwell, first_events), (wh.raw_vessel_calls, wh.raw_shipments)):
        run_incremental_partitioned(dwell, _dwell_builder(wh), calls, ["dwell_key"], lookback=back_dwell)
        run_incremental_partitioned(events, _partitioned_builder(wh), shipments, ["shipment_id"], lookback=back_events)
        after_each(dwell, events)


def congestion_incremental(wh) -> DataFrame:
    """J17 in two runs with late, moved and new rows between them: only the (port, week)
    keys they touch are modelled again."""
    t = _table(wh, "congestion_delay_impact")
    _facts_in_two_runs(wh, lambda dwell, events: mart_runs.congestion_run(t, dwell, events, wh.dim_port_b))
    return t.read()


def throughput_late_rows(wh) -> DataFrame:
    """J14 in two runs with late calls for past days between them."""
    t = _table(wh, "port_throughput_daily_late")
    _facts_in_two_runs(wh, lambda dwell, events: mart_runs.throughput_run(t, dwell, wh.dim_port_b, wh.dim_date_b))
    return t.read()


REDELIVERED_EVERY = 7


def redelivered(raw: DataFrame) -> DataFrame:
    """Later versions of one shipment in seven: another cargo, destination and arrival."""
    k = F.substring("shipment_id", 2, 20).cast("long")
    return raw.filter(k % REDELIVERED_EVERY == 0).withColumns({
        "cargo_type": F.lit("Vehicles"), "dest_port": F.concat(F.lit("nation_"), ((k + 1) % 26).cast("string")),
        "ata": F.col("eta") + F.expr("INTERVAL 30 HOURS"), "_loaded_at": F.col("_loaded_at") + F.make_ym_interval(F.lit(10))})


def carrier_performance_redelivered(wh) -> DataFrame:
    """J13 after shipments were delivered again with other values: the fact holds their
    latest version, and so does the layer that gives the lanes."""
    wh = wh.with_stored_feed()
    again = wh.raw_shipments.unionByName(redelivered(wh.raw_shipments))
    t, build = _ptable(wh, "fct_shipment_events_again"), _partitioned_builder(wh)
    for feed in (wh.raw_shipments, again):
        run_incremental_partitioned(t, build, feed, ["shipment_id"])
    latest = wh.materialize("latest_redelivered", latest_rows(staging.stg_shipments(again), ["shipment_id"], ["_loaded_at"]))
    return marts.carrier_performance(t.read(), wh.dim_carrier_b, latest, wh.dim_port_b)
