"""Bronze CSV ingestion (survey A1-A8, A17, L25).

* ``read_bronze_csv``: header skipped, optional ``"`` quotes, every field read
  as text, the tokens ``NULL``, ``null`` and the empty string turned into
  NULL, then typed with ``try_cast`` (Spark's ``nullValue`` accepts only one
  token, so the tokens are handled after the read).
* Tolerant load (``ON_ERROR = CONTINUE``): rows with the wrong number of
  fields (PERMISSIVE mode's corrupt-record column) or a non-empty value that
  does not cast are rejected, the rest are loaded; ``load_audit`` reports
  rows parsed/loaded, the first error and a status per file.
* ``ingest_files``: idempotent file ingest as a file-source stream with a
  checkpoint and ``availableNow``; files already in the checkpoint are never
  loaded again (keyed by path).  Its batches keep rejected lines and a history
  (``sources.csv_load``).
* ``append_bronze``: append-only bronze sink partitioned by load date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.files import path_exists
from . import csv_load, schemas

NULL_TOKENS = ["NULL", "null", ""]
CORRUPT = "_corrupt_record"


def _text_schema(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` string" for f in schema.fields) + f", `{CORRUPT}` string"


def _typed(raw: DataFrame, schema: StructType) -> DataFrame:
    """Null tokens -> NULL, then ``try_cast`` to the declared types; adds
    ``_bad_cast`` = some non-null text failed to cast."""
    cols, bad = [], F.lit(False)
    for f in schema.fields:
        txt = F.when(F.col(f.name).isin(*NULL_TOKENS), F.lit(None)).otherwise(F.col(f.name))
        typed = txt.try_cast(f.dataType) if f.dataType.simpleString() != "string" else txt
        cols.append(typed.alias(f.name))
        bad = bad | (txt.isNotNull() & typed.isNull())
    return raw.select(*cols, F.col(CORRUPT), bad.alias("_bad_cast"),
                      F.col("_metadata.file_path").alias("_file"))


def read_bronze_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parse CSV text files into typed rows plus rejection flags."""
    raw = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("nullValue", "\u0000").option("emptyValue", "")
           .schema(_text_schema(schema)).csv(path))
    return _typed(raw, schema)


def split_loaded(parsed: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows with the target columns, rejected rows)."""
    rejected = F.col(CORRUPT).isNotNull() | F.col("_bad_cast")
    good = parsed.filter(~rejected).select(*[f.name for f in schema.fields])
    return good, parsed.filter(rejected)


def load_bronze_csv(spark: SparkSession, path: str, schema: StructType,
                    loaded_at_col: str | None = "_loaded_at") -> DataFrame:
    """A1-A4: tolerant typed load; ``_loaded_at`` defaults to one timestamp
    for the whole batch when the file does not carry it."""
    good, _ = split_loaded(read_bronze_csv(spark, path, schema), schema)
    if loaded_at_col and loaded_at_col not in [f.name for f in schema.fields]:
        good = good.withColumn(loaded_at_col, F.current_timestamp().cast("timestamp_ntz"))
    return good


def load_audit(parsed: DataFrame, table_name: str) -> DataFrame:
    """Per file: rows parsed, rows loaded, first error, status."""
    rejected = F.col(CORRUPT).isNotNull() | F.col("_bad_cast")
    err = (F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of fields: "))
           .otherwise(F.lit("value not castable: ")))
    rej_text = F.when(rejected, F.concat(err, F.coalesce(F.col(CORRUPT), F.lit("typed columns"))))
    g = parsed.groupBy(F.col("_file").alias("file_name")).agg(
        F.count(F.lit(1)).alias("row_parsed"),
        F.sum(F.when(rejected, 0).otherwise(1)).cast("long").alias("row_count"),
        F.min(rej_text).alias("first_error_message"))
    status = (F.when(F.col("row_count") == F.col("row_parsed"), "LOADED")
              .when(F.col("row_count") == 0, "LOAD_FAILED").otherwise("PARTIALLY_LOADED"))
    return g.select(F.lit(table_name).alias("table_name"),
                    F.element_at(F.split("file_name", "/"), -1).alias("file_name"),
                    "row_count", "row_parsed", "first_error_message", status.alias("status"))


def read_if_exists(spark: SparkSession, path: str, reader) -> DataFrame | None:
    """A missing input is skipped with a warning; the run continues."""
    if not path_exists(spark, path):
        print(f"[WARN] {path} not found — skipping.")
        return None
    return reader(spark, path)


def append_bronze(df: DataFrame, path: str) -> None:
    """Append-only bronze sink, partitioned by load date for pruning."""
    (df.withColumn("load_date", F.to_date("_loaded_at"))
     .write.mode("append").partitionBy("load_date").parquet(path))


def create_table_if_absent(spark: SparkSession, name: str, schema: StructType, location: str) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` from a StructType."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet LOCATION '{location}'")


HISTORY = "_load_history"


def ingest_files(spark: SparkSession, src_dir: str, schema: StructType, target: str, checkpoint: str,
                 table_name: str = "", load_time: dt.datetime | None = None,
                 aliases: dict[str, str] | None = None) -> int:
    """A5: load files not loaded before (file-source stream + checkpoint, ``availableNow``).
    Each micro-batch stages all its lines, good and bad, in its own folder under
    ``target`` and adds its files to the load history; both are overwritten when a batch
    is replayed.  Returns the rows added."""
    counts = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        at = load_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        out = f"{target}/batch_{batch_id:08d}"
        counts.append(csv_load.stage(batch, schema, out, at, aliases))
        (csv_load.audit(batch.sparkSession.read.parquet(out), table_name, at)
         .write.mode("overwrite").parquet(f"{target}/{HISTORY}/batch_{batch_id:08d}"))

    lines = csv_load.text_lines(spark.readStream.text(src_dir))
    q = lines.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return sum(counts)


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all batches."""
    return csv_load.loaded(spark.read.parquet(f"{target}/batch_*"))


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    """The rejected lines of all batches."""
    return csv_load.rejected(spark.read.parquet(f"{target}/batch_*"))


def load_history(spark: SparkSession, target: str) -> DataFrame:
    """One row per file ever loaded."""
    return spark.read.parquet(f"{target}/{HISTORY}/batch_*")


def seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Typed seed CSV (literal ``NULL`` fields become NULL)."""
    parsed = read_bronze_csv(spark, path, schema)
    good, _ = split_loaded(parsed, schema)
    return good


__all__ = ["read_bronze_csv", "load_bronze_csv", "load_audit", "ingest_files", "append_bronze",
           "create_table_if_absent", "seed", "read_if_exists", "schemas"]
