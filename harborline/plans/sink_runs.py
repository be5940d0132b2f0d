"""Stored layers as queries (survey A7, A11, A12, A15, A17, C11, H4): each writes real
tables from the bound feeds and returns what a reader finds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import lit_ntz, minutes_between
from ..operators.incremental import PartitionedTable, VersionedTable
from ..session import shared_dir
from ..sources import bronze_csv, schemas
from . import batch_run, marts
from .mart_runs import ARRIVAL_MONTH, DEPARTURE_MONTH


def _scratch(wh, name: str) -> str:
    return shared_dir(wh.spark, f"sinks/{name}-{uuid.uuid4().hex[:12]}")


def bronze_append(wh) -> DataFrame:
    """The calls appended in two deliveries, partitioned by load date."""
    path, calls = _scratch(wh, "bronze_calls"), wh.raw_vessel_calls
    middle = lit_ntz(calls.agg(F.percentile_approx(F.col("_loaded_at").cast("timestamp"), 0.5)).first()[0])
    for part in (calls.filter(F.col("_loaded_at") <= middle), calls.filter(F.col("_loaded_at") > middle)):
        bronze_csv.append_bronze(part, path)
    stored = wh.spark.read.parquet(path)
    return stored.filter(F.to_date("_loaded_at") == F.col("load_date")).drop("load_date")


def bronze_table(wh) -> DataFrame:
    """A table created once from its declared schema; asked for again, it is left as
    it is, rows included."""
    name, path = f"harborline_calls_{uuid.uuid4().hex[:12]}", _scratch(wh, "table_calls")
    bronze_csv.create_table_if_absent(wh.spark, name, schemas.RAW_VESSEL_CALLS, path)
    wh.raw_vessel_calls.select(*schemas.RAW_VESSEL_CALLS.names).write.insertInto(name)
    bronze_csv.create_table_if_absent(wh.spark, name, schemas.RAW_VESSEL_CALLS, path)
    return wh.spark.table(name)


def lake_tables(wh) -> DataFrame:
    """Rows per stored table and silver view of a batch run, by layer."""
    spark, root = wh.spark, _scratch(wh, "lake")
    batch_run.run(spark, wh.sf_dir, root, wh.as_of)

    def rows(layer: str, name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
    out = [rows("silver", n, spark.table(f"silver_{n}")) for n, layer in batch_run.LAYER_OF.items() if layer == "silver"]
    out += [rows("gold", n, spark.read.parquet(f"{root}/gold/{n}"))
            for n in [*(n for n, layer in batch_run.LAYER_OF.items() if layer == "gold"),
                      *batch_run.DIMENSIONS, *batch_run.FULL_MARTS]]
    for n, part in (("fct_shipment_events", DEPARTURE_MONTH), ("fct_port_dwell", ARRIVAL_MONTH), ("fct_landed_cost", "eta_month")):
        out.append(rows("gold", n, PartitionedTable(spark, f"{root}/gold/{n}", part).read()))
    for n in ("port_throughput_daily", "congestion_delay_impact"):
        out.append(rows("gold", n, VersionedTable(spark, f"{root}/gold/{n}").read()))
    first, *rest = out
    for df in rest:
        first = first.unionByName(df)
    return first


def catchment_in_order(wh) -> DataFrame:
    """H4: the catchment table stored by distance: rows, and rows nearer than one that an
    earlier file or an earlier place of their own file holds."""
    path = _scratch(wh, "catchment")
    marts.by_distance(wh.port_catchment_area).write.parquet(path)
    stored = wh.spark.read.parquet(path).select("distance_km", F.col("_metadata.file_name").alias("file"),
                                                F.col("_metadata.row_index").alias("place"))
    before = F.lag("distance_km").over(Window.partitionBy("file").orderBy("place"))
    inside = stored.withColumn("before", before).agg(
        F.count(F.lit(1)).alias("row_count"), F.count(F.when(F.col("before") > F.col("distance_km"), 1)).alias("rows_inside"))
    files = stored.groupBy("file").agg(F.min("distance_km").alias("lo"), F.max("distance_km").alias("hi"))
    so_far = F.max("hi").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))   # one row per file
    between = files.withColumn("so_far", so_far).agg(F.count(F.when(F.col("so_far") > F.col("lo"), 1)).alias("files_between"))
    both = inside.unionByName(between, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in
                                                                       ("row_count", "rows_inside", "files_between")])
    return both.select("row_count", (F.col("rows_inside") + F.col("files_between")).alias("out_of_order"))


def berth_wait_minutes(wh) -> DataFrame:
    """C11: minutes between arrival and berth per call port."""
    wait = minutes_between("arrival_ts", "berth_ts")
    return (wh.stg_vessel_calls.groupBy("port_code")
            .agg(F.sum(wait).alias("wait_minutes"), F.min(wait).alias("shortest"), F.max(wait).alias("longest")))
