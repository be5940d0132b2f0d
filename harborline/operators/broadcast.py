"""Broadcast only what has a checked size bound.

Seeds (ports, tariffs, FX rates) and the calendar are small by construction,
but the check is still made: the side is broadcast only when its row count is
at most ``max_rows``.  A side above the bound is returned unhinted, so the
planner falls back to a shuffle join (and AQE may still convert it at run time
from the measured shuffle size).  Data-derived dimensions whose size grows
with the facts are never hinted; AQE decides for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 200_000


def row_bound_ok(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.  Counted where the rows are: of a
    stored table that is its footers, and no row leaves its task."""
    return df.count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` if its size is proven to be at most ``max_rows`` rows.

    ``known_rows`` is a static bound (e.g. the 4,018-day calendar) that saves
    the counting job.
    """
    ok = known_rows <= max_rows if known_rows is not None else row_bound_ok(df, max_rows)
    return F.broadcast(df) if ok else df
