"""Plan shape: no nested-loop/cartesian joins, no Python UDFs, pruned scans."""

from __future__ import annotations

import contextlib
import io

import pytest

from __spark_entry__ import queries

from .conftest import SF_SMALL
from .test_oracle import NAMES


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", NAMES)
def test_no_bad_operators(spark, name):
    p = plan(queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas"):
        assert bad not in p, f"{name}: {bad}"


def _raw_wh(spark):
    from harborline.registry import warehouse
    return warehouse(spark, SF_SMALL, store_layers=False)


def test_landed_cost_uses_hash_join_for_fx(spark):
    p = plan(_raw_wh(spark).fct_landed_cost)
    assert "BroadcastHashJoin" in p and "Generate" in p and "explode(" in p


def test_scan_prunes_columns(spark):
    p = plan(_raw_wh(spark).port_throughput_daily)
    # the events scan reads only what the vessel-call binding needs
    line = [ln for ln in p.splitlines() if "ReadSchema" in ln and "event_id" in ln][0]
    assert "props" not in line and "value" not in line


def test_facts_never_broadcast(spark):
    # the shipments are as large as the fact: joined by shuffle/AQE, not hinted, and their
    # latest versions are found without an aggregate that sorts all columns
    p = plan(_raw_wh(spark).carrier_performance)
    assert "WindowGroupLimit" in p and "SortAggregate" not in p


def test_stored_shipment_tables_join_without_a_shuffle(spark):
    from harborline.plans import marts
    from harborline.registry import warehouse
    wh = warehouse(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # a plan of its own: one that ran before keeps its final plan
        performance = marts.carrier_performance(wh.fct_shipment_events, wh.dim_carrier_b, wh.latest_shipments, wh.dim_port_b)
        for df in (performance, queries()["cost_by_cargo_type"](spark, SF_SMALL)):
            p = plan(df)
            assert "SortMergeJoin" in p and "SortAggregate" not in p
            assert "hashpartitioning(shipment_id" not in p and "Bucketed: true" in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
