"""The scheduled batch run: layered outputs, incremental facts/marts,
idempotent re-run, data tests."""

from __future__ import annotations

import os
import tempfile

from harborline.operators.incremental import PartitionedTable, VersionedTable
from harborline.plans import batch_run
from harborline.registry import warehouse

from .conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batch_run_twice_is_idempotent(spark):
    out = os.path.join(tempfile.mkdtemp(), "lake")
    r1 = batch_run.run(spark, SF_SMALL, out)
    wh = warehouse(spark, SF_SMALL)
    ev = PartitionedTable(spark, batch_run.layer_path(out, "fct_shipment_events"), "etd_month")
    ptd = VersionedTable(spark, batch_run.layer_path(out, "port_throughput_daily"))
    first_ev, first_ptd = ev.read().drop("etd_month").cache(), ptd.read().cache()
    assert _same(first_ev, wh.fct_shipment_events)
    assert _same(first_ptd, wh.port_throughput_daily)
    assert os.path.isdir(os.path.join(out, "silver")) is False        # silver models are views
    assert os.path.isdir(os.path.join(out, "gold", "dim_port"))
    batch_run.run(spark, SF_SMALL, out)
    assert _same(ev.read().drop("etd_month"), first_ev)
    dwell = PartitionedTable(spark, batch_run.layer_path(out, "fct_port_dwell"), "arrival_month")
    assert _same(dwell.read().drop("arrival_month"), wh.fct_port_dwell)
    assert _same(ptd.read(), first_ptd)
    # the planted traps show up as failing declared tests (e.g. duplicate entry numbers)
    failing = {(t["model"], t["column_name"], t["test"]) for t in r1["failing_tests"]}
    assert ("stg_customs_entries", "entry_number", "unique") in failing
    assert ("stg_shipments", "shipment_id", "unique") not in failing
