"""Property tests against brute force on small random inputs."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harborline.operators.asof import attach_daily_rate

BASE = dt.date(2026, 1, 1)
rates_st = st.lists(st.tuples(st.integers(0, 40), st.integers(5000, 6000)), min_size=0, max_size=12)
days_st = st.lists(st.integers(-5, 50), min_size=1, max_size=10)


def _brute(rates, day, mode):
    rows = [(d, v) for d, v in rates if d <= day]
    if not rows:
        return None
    if mode == "max_to_date":
        return max(v for _, v in rows)
    last = max(d for d, _ in rows)
    return max(v for d, v in rows if d == last)


@settings(max_examples=12, deadline=None)
@given(rates=rates_st, days=days_st)
def test_daily_rate_lookup_equals_brute_force(spark, rates, days):
    r = spark.createDataFrame([(BASE + dt.timedelta(days=d), v) for d, v in rates],
                              "rate_date date, rate int")
    f = spark.createDataFrame([(i, BASE + dt.timedelta(days=d)) for i, d in enumerate(days)], "i int, d date")
    for mode in ("max_to_date", "asof"):
        got = {row.i: row.x for row in attach_daily_rate(f, F.col("d"), r, "rate_date", "rate", "x", mode).collect()}
        want = {i: _brute(rates, d, mode) for i, d in enumerate(days)}
        assert got == want, mode
