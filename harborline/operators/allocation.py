"""Dividing an amount among shares so that the cents add up (survey O4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share_out(df: DataFrame, group: str, amount: str, weight: str, fallback: str, tie: str) -> DataFrame:
    """``df`` with ``share``: the group's ``amount`` (not negative, the same in all its rows)
    divided by ``weight``, in whole cents, by largest remainders: every row has its share
    rounded down, and the cents left over go to the largest remainders, one each (ties:
    smallest ``tie``, a null last).  Where a group's weights are all 0, ``fallback`` weighs.
    A group should be reduced to few rows first; its rows meet in one task."""
    rows = Window.partitionBy(group)
    cents = (F.col(amount) * 100).cast("decimal(18,0)")
    by_weight = (F.col(weight) * 100).cast("decimal(18,0)")
    whole = F.sum(by_weight).over(rows)
    own = F.when(whole > 0, by_weight).otherwise(F.col(fallback).cast("decimal(18,0)"))
    d = df.withColumns({"__cents": cents, "__own": own})
    d = d.withColumn("__all", F.sum("__own").over(rows).cast("decimal(18,0)"))
    d = d.withColumns({"__down": F.expr("(__cents * __own) div __all"), "__rest": F.expr("(__cents * __own) % __all")})
    by_rest = rows.orderBy(F.col("__rest").desc(), F.col(tie).asc_nulls_last())
    left = F.col("__cents") - F.sum("__down").over(rows)
    extra = F.when(F.row_number().over(by_rest) <= left, 1).otherwise(0)
    return (d.withColumn("share", ((F.col("__down") + extra).cast("decimal(20,0)") / 100).cast("decimal(20,2)"))
            .drop("__cents", "__own", "__all", "__down", "__rest"))
