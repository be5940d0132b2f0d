"""Sliding windows from panes (survey M2).

A window of ``n`` panes that slides by one pane is the sum of ``n`` neighbouring
panes.  Instead of copying every row into its ``n`` windows, rows are summed per
pane once; each pane then enters the running sum ``n - 1`` panes before its own
place and leaves it one pane after, so a key's windows are a running sum over two
rows per pane.  Between two changes all windows hold the same sums: they are laid
out by a sequence, one row per window of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def pane_of(ts: Column, minutes: int) -> Column:
    """The number of the pane that a wall-clock time lies in."""
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return F.floor((day * 1440 + F.hour(ts) * 60 + F.minute(ts)) / F.lit(minutes)).cast("long")


def pane_start(pane: Column, minutes: int) -> Column:
    return F.timestamp_add("MINUTE", (pane * minutes).cast("long"), F.lit(EPOCH).cast("timestamp_ntz"))


def sliding_sums(panes: DataFrame, keys: list[str], sums: list[str], n: int, pane_col: str = "pane",
                 count_col: str | None = None) -> DataFrame:
    """(keys, first pane of the window, sums) of every window that holds a row.

    ``panes`` has one row per key and pane with whole-number ``sums``; ``count_col``
    (the first of them by default) counts rows.  A key's changes meet in one task:
    two rows per pane, so at most twice a calendar's panes, whatever the number of rows."""
    count_col = count_col or sums[0]
    enters = panes.select(*keys, (F.col(pane_col) - (n - 1)).alias("window"), *sums)
    leaves = panes.select(*keys, (F.col(pane_col) + 1).alias("window"), *[(-F.col(c)).alias(c) for c in sums])
    changes = enters.unionByName(leaves).groupBy(*keys, "window").agg(*[F.sum(c).alias(c) for c in sums])
    in_order = Window.partitionBy(*keys).orderBy("window")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    held = changes.select(*keys, "window", F.lead("window").over(in_order).alias("__next"),
                          *[F.sum(c).over(so_far).alias(c) for c in sums])
    return (held.filter(F.col(count_col) > 0)
            .withColumn("window", F.explode(F.sequence("window", F.col("__next") - 1))).drop("__next"))
