"""Every query with an oracle matches DuckDB on sf0.001 (rows + values)."""

from __future__ import annotations

import decimal
import math

import pytest

from __spark_entry__ import oracle_sql, queries
from harborline.registry import ORACLE

from .conftest import SF_SMALL

# Queries that write files or run streams are covered in test_runs.py and test_streams.py.
SLOW = {"incremental_upsert", "incremental_key_move", "throughput_incremental", "incremental_rerun_noop", "late_rows_lookback",
        "congestion_incremental", "throughput_late_rows", "carrier_performance_redelivered", "csv_null_tokens", "load_audit",
        "csv_rejects", "csv_rejected_lines", "lake_tables", "csv_header_load", "skipped_inputs", "incremental_full_refresh", "ingest_idempotent", "seed_ports", "stream_active_shipments",
        "stream_port_congestion", "stream_unknown_ports", "stream_late_calls", "stream_lag", "stream_fact_upsert", "stream_dedup"}
NAMES = sorted(k for k in ORACLE if k not in SLOW)


def _norm(v):
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else v)
    if isinstance(v, decimal.Decimal):
        return ("d", str(v.normalize()))
    if v is None:
        return ("", "")
    return (type(v).__name__, str(v))


def _rows(records, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in idx) for r in records)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    res = duck.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), res.columns)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "rolling_7d_avg_dwell_hours" in df.columns
