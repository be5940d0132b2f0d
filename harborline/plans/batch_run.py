"""The scheduled batch run (survey 3.1, A11-A15, H4, K*).

``run(spark, sf_dir, out_root, as_of)`` materialises every layer in the
reference's order: seeds -> silver views -> gold dimensions -> incremental
facts -> marts (two of them incremental) -> data tests.  Each model is the
same DataFrame function the queries use; this module only decides where and
how each result is stored:

* silver models are *views* (temp views, lazily inlined by Catalyst, A11);
* dimensions and plain marts are fully replaced tables (A12);
* facts are partitioned by month (departure, arrival, ETA) and upserted past
  their watermark by dynamic partition overwrite, touching only the months a
  delta reaches (A13); the two incremental marts follow the rows that changed in
  the facts, by (port, day) and (port, week) key; ``full_refresh=True`` rebuilds (A14);
* every output goes to ``<out_root>/<layer>/<table>`` (A15, no prefixing);
* ``port_catchment_area`` is stored range-partitioned and sorted by distance
  (H4: order inside a table is a storage choice, not a contract).

Running it twice on the same input leaves every table unchanged (the
watermarks pass nothing the second time).  Snapshots before the last two are
deleted at the end.  All data tests run on the stored tables; failing ones end the
command with exit code 1.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import PartitionedTable, VersionedTable, run_incremental_partitioned
from . import facts, mart_runs, marts, quality, staging
from .mart_runs import ARRIVAL_MONTH, DEPARTURE_MONTH, month_of
from .warehouse import DEFAULT_AS_OF, Warehouse

LAYER_OF = {"ph_ports": "gold", "ph_tariff_rates": "gold", "usd_php_rates": "gold",
            "stg_vessel_calls": "silver", "stg_shipments": "silver", "stg_customs_entries": "silver"}
DIMENSIONS = ["dim_date", "dim_port", "dim_vessel", "dim_carrier", "dim_shipment", "dim_customs_entry"]
FULL_MARTS = ["carrier_performance", "customs_clearance_kpi", "commodity_cost_summary", "port_catchment_area"]


def layer_path(root: str, table: str) -> str:
    """``<root>/<layer>/<table>``; models default to gold."""
    return f"{root.rstrip('/')}/{LAYER_OF.get(table, 'gold')}/{table}"


def run(spark: SparkSession, sf_dir: str, out_root: str, as_of: dt.datetime = DEFAULT_AS_OF,
        full_refresh: bool = False, fail_on_test_errors: bool = False) -> dict:
    wh = Warehouse(spark, sf_dir, as_of=as_of).with_stored_feed()
    report: dict = {"tables": {}}

    def put(name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(layer_path(out_root, name))

    # seeds (full refresh every run)
    put("ph_ports", wh.bronze.ph_ports)
    put("ph_tariff_rates", wh.ph_tariff_rates)
    put("usd_php_rates", wh.usd_php_rates)

    # silver: views over bronze
    for name in ["stg_vessel_calls", "stg_shipments", "stg_customs_entries"]:
        getattr(wh, name).createOrReplaceTempView(f"silver_{name}")

    # gold dimensions: fully replaced
    for name in DIMENSIONS:
        put(name, getattr(wh, name))

    # incremental facts
    ev = PartitionedTable(spark, layer_path(out_root, "fct_shipment_events"), DEPARTURE_MONTH)

    def build_events(raw: DataFrame) -> DataFrame:
        f = facts.fct_shipment_events(staging.stg_shipments(raw), None, wh.dim_date, wh.dim_port_b, None)
        return f.withColumn(DEPARTURE_MONTH, month_of("etd"))
    report["tables"]["fct_shipment_events"] = run_incremental_partitioned(
        ev, build_events, wh.raw_shipments, ["shipment_id"], full_refresh=full_refresh)

    dwell = PartitionedTable(spark, layer_path(out_root, "fct_port_dwell"), ARRIVAL_MONTH)

    def build_dwell(raw: DataFrame) -> DataFrame:
        f = facts.fct_port_dwell(staging.stg_vessel_calls(raw), wh.dim_vessel_b, wh.dim_date, wh.dim_port_b)
        return f.withColumn(ARRIVAL_MONTH, month_of("arrival_date_key"))
    report["tables"]["fct_port_dwell"] = run_incremental_partitioned(
        dwell, build_dwell, wh.raw_vessel_calls, ["dwell_key"], full_refresh=full_refresh)

    landed = PartitionedTable(spark, layer_path(out_root, "fct_landed_cost"), "eta_month")

    def build_landed(raw: DataFrame) -> DataFrame:
        f = facts.fct_landed_cost(staging.stg_shipments(raw), wh.tariffs_b, wh.usd_php_rates,
                                  as_of.date(), wh.fx_mode)
        return f.withColumn("eta_month", month_of("eta_date_key"))
    report["tables"]["fct_landed_cost"] = run_incremental_partitioned(
        landed, build_landed, wh.raw_shipments, ["shipment_id"], full_refresh=full_refresh)

    # marts read the stored facts (as in the reference)
    fse = ev.read().drop(DEPARTURE_MONTH)
    fpd = dwell.read().drop(ARRIVAL_MONTH)
    flc = landed.read().drop("eta_month")
    latest = wh.materialize("latest_shipments", wh.latest_shipments)
    for name in FULL_MARTS:
        if name == "carrier_performance":
            df = marts.carrier_performance(fse, wh.dim_carrier_b, latest, wh.dim_port_b)
        elif name == "customs_clearance_kpi":
            df = marts.customs_clearance_kpi(wh.dim_customs_entry, wh.dim_port_b)
        elif name == "commodity_cost_summary":
            df = marts.commodity_cost_summary(flc, latest, wh.tariffs_b, wh.dim_port_b)
        else:
            df = marts.by_distance(marts.port_catchment_area(fse, wh.dim_port, wh.port_pairs))
        put(name, df)

    # incremental marts: the keys of the fact rows that changed
    throughput = VersionedTable(spark, layer_path(out_root, "port_throughput_daily"))
    report["tables"]["port_throughput_daily"] = mart_runs.throughput_run(
        throughput, dwell, wh.dim_port_b, wh.dim_date_b, full_refresh)
    congestion = VersionedTable(spark, layer_path(out_root, "congestion_delay_impact"))
    report["tables"]["congestion_delay_impact"] = mart_runs.congestion_run(
        congestion, dwell, ev, wh.dim_port_b, full_refresh)

    # data tests over the stored tables
    stored = {n: spark.read.parquet(layer_path(out_root, n)) for n in DIMENSIONS + FULL_MARTS}
    stored.update({"fct_shipment_events": fse, "fct_port_dwell": fpd, "fct_landed_cost": flc,
                   "port_throughput_daily": throughput.read(), "congestion_delay_impact": congestion.read(),
                   "stg_vessel_calls": wh.stg_vessel_calls, "stg_shipments": wh.stg_shipments,
                   "stg_customs_entries": wh.stg_customs_entries})
    sources = {"raw_vessel_calls": wh.raw_vessel_calls, "raw_shipments": wh.raw_shipments,
               "raw_customs_entries": wh.raw_customs_entries}
    tests = quality.data_tests({**stored, **sources}, sources, as_of)
    found = [r.asDict() for r in tests.filter(F.col("failing_rows") > 0).collect()]  # one row per test
    report["failing_tests"] = [t for t in found if t["severity"] == "error"]
    report["warnings"] = [t for t in found if t["severity"] == "warn"]
    for t in (ev, dwell, landed, throughput, congestion):
        t.vacuum()
    if fail_on_test_errors and report["failing_tests"]:
        raise RuntimeError(f"{len(report['failing_tests'])} data tests failed")
    return report


__all__ = ["run", "layer_path"]


def main(argv: list[str]) -> int:
    """``python -m harborline.plans.batch_run SF_DIR OUT_ROOT [--as-of TIME] [--full-refresh]``

    TIME (ISO) is the evaluation time, by default the wall clock in UTC.  Exit code 1
    when a data test fails, after all tables are written."""
    import argparse
    import json

    from ..session import build_session
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("sf_dir")
    parser.add_argument("out_root")
    parser.add_argument("--as-of", type=dt.datetime.fromisoformat)
    parser.add_argument("--full-refresh", action="store_true")
    args = parser.parse_args(argv)
    as_of = args.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    report = run(build_session(app="harborline-batch-run"), args.sf_dir, args.out_root, as_of, args.full_refresh)
    print(json.dumps({"as_of": as_of.isoformat(), "failing_tests": report["failing_tests"], "warnings": report["warnings"],
                      "tables": {k: v if isinstance(v, int) else len(v or []) for k, v in report["tables"].items()}}))
    return 1 if report["failing_tests"] else 0


if __name__ == "__main__":
    import sys
    sys.exit(main(sys.argv[1:]))
