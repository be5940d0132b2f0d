"""Work per row of the CSV feeds: a row is made once, a line is parsed once."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from harborline.operators import files
from harborline.plans import ingest_runs
from harborline.sources import csv_load
from harborline.sources.schemas import _ddl

SCHEMA = _ddl("id string, n int, amount decimal(15,2), day date, _loaded_at timestamp_ntz")
AT = dt.datetime(2026, 5, 4, 3, 2, 1)


def _scratch() -> str:
    return os.path.join(tempfile.mkdtemp(), uuid.uuid4().hex)


def test_rows_in_pieces_are_made_once(spark, monkeypatch):
    """Finding the borders of the pieces reads the keys only."""
    monkeypatch.setattr(files, "ROWS_PER_FILE", 50)
    made = spark.sparkContext.accumulator(0)

    def name(n: int) -> str:
        made.add(1)
        return f"r{n}"
    rows = spark.range(400).select(
        F.udf(name, "string")("id").alias("id"), F.col("id").cast("int").alias("n"), F.lit("1.50").cast("decimal(15,2)").alias("amount"),
        F.lit(None).cast("date").alias("day"), F.lit(AT).cast("timestamp_ntz").alias("_loaded_at"))
    path, n = _scratch(), F.col("n")
    ingest_runs.write_csv_lines(rows, SCHEMA, path, n_files=2, bad_int=("n", n == 7), file_id=n % 2, order=[n])
    assert made.value == 400
    staged = csv_load.load_files(spark, path, SCHEMA, _scratch(), AT)
    assert sorted((r.n, r.id) for r in csv_load.loaded(staged).collect()) == [(i, f"r{i}") for i in range(400) if i != 7]
    assert [(r.file_name, r.line_number) for r in csv_load.rejected(staged).collect()] == [("part-00001", 5)]


def test_pieces_keep_repeated_and_null_keys(spark, monkeypatch):
    """All rows of one key, and keys that are null: every row arrives, in the order of the keys."""
    monkeypatch.setattr(files, "ROWS_PER_FILE", 20)
    keys = [None] * 50 + [3] * 150 + list(range(4, 54))
    rows = spark.createDataFrame([(f"r{i}", k) for i, k in enumerate(keys)], "id string, n int").select(
        "id", "n", F.lit(None).cast("decimal(15,2)").alias("amount"), F.lit(None).cast("date").alias("day"),
        F.lit(AT).cast("timestamp_ntz").alias("_loaded_at"))
    path, n = _scratch(), F.col("n")
    ingest_runs.write_csv_lines(rows, SCHEMA, path, n_files=1, bad_int=("n", n == 53), file_id=F.lit(None).cast("long"), order=[n])
    staged = csv_load.load_files(spark, path, SCHEMA, _scratch(), AT)
    assert sorted(r.id for r in csv_load.loaded(staged).collect()) == sorted(f"r{i}" for i in range(249))
    assert [(r.file_name, r.line_number) for r in csv_load.rejected(staged).collect()] == [("part-00000", 251)]


def test_a_line_is_parsed_and_a_field_cast_once(spark):
    lines = spark.createDataFrame([("a,1,2.50,2026-01-01", "f", 0)], "value string, file string, block long").withColumn("pos", F.lit(1))
    rows, columns, reason = csv_load._parsed(lines, "id,n,amount,day", SCHEMA, {}, AT)
    plan = rows.select(*columns, reason.alias("reason"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") + plan.count("CsvToStructs") == 1, plan
    assert plan.count("as int)") == plan.count("as date)") == 1, plan


def _scans_of_lines(df) -> int:
    """How often the plan of ``df`` scans staged lines, other than those that are no row or no good one."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("FileScan parquet ")[1:] if "_place" in x.split("ReadSchema")[0]]
    return sum("like_header" not in x and "IsNotNull(_place.error)" not in x for x in scans)


def test_the_audit_scans_all_lines_once(spark):
    """Counts, files and line numbers come from one small table of the splits."""
    path = _scratch()
    os.makedirs(path)
    for name, bad in (("a.csv", "x"), ("b.csv", "2")):
        with open(f"{path}/{name}", "w", encoding="utf-8") as f:
            f.write(f"id,n\nr1,1\nid,n\n\nr2,{bad}\n")
    with open(f"{path}/c.csv", "w", encoding="utf-8") as f:
        f.write("id\nid\n")
    staged = csv_load.load_files(spark, path, SCHEMA, _scratch(), AT)
    audit, rejected = csv_load.audit(staged, "t", AT), csv_load.rejected(staged)
    assert _scans_of_lines(audit) == _scans_of_lines(rejected) == 0
    got = sorted((r.file_name, r.row_parsed, r.row_count, r.first_error_line_number) for r in audit.collect())
    assert got == [("a.csv", 3, 1, 3), ("b.csv", 3, 2, 3), ("c.csv", 1, 1, None)]
    assert sorted((r.file_name, r.line_number) for r in rejected.collect()) == [("a.csv", 3), ("a.csv", 5), ("b.csv", 3)]
