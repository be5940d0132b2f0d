"""Steps whose tasks must not grow with the table: files, pieces of files, stored layers."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from harborline.operators import files
from harborline.plans import ingest_runs, marts, monitoring
from harborline.plans.warehouse import Warehouse
from harborline.session import shared_dir
from harborline.sources import csv_load
from .conftest import SF_SMALL
from harborline.sources.schemas import _ddl

SCHEMA = _ddl("id string, n int, _loaded_at timestamp_ntz")
AT = dt.datetime(2026, 5, 4, 3, 2, 1)


@pytest.fixture()
def few_rows_a_file(monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_FILE", 50)


def _scratch() -> str:
    return os.path.join(tempfile.mkdtemp(), uuid.uuid4().hex)


def _parts(path: str) -> list[int]:
    """Lines of every text file under ``path``."""
    found = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]
    return [sum(1 for _ in open(f, encoding="utf-8")) for f in found]


def _rows(spark, n):
    return spark.range(n).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"), F.col("id").cast("int").alias("n"),
                                 F.lit(AT).cast("timestamp_ntz").alias("_loaded_at"))


def test_csv_files_grow_in_number(spark, few_rows_a_file):
    path = _scratch()
    ingest_runs.write_csv_lines(_rows(spark, 1000), SCHEMA, path, n_files=2)
    assert len(_parts(path)) == 20 and max(_parts(path)) < 150
    staged = csv_load.load_files(spark, path, SCHEMA, _scratch(), AT)
    assert sorted(r.n for r in csv_load.loaded(staged).collect()) == list(range(1000))


def test_dealt_files_come_in_pieces(spark, few_rows_a_file):
    """Two files of 500 rows and a third without rows: many pieces, but one header and one count of lines each."""
    path, n = _scratch(), F.col("n")
    ingest_runs.write_csv_lines(_rows(spark, 1000), SCHEMA, path, n_files=3, bad_int=("n", n % 100 == 7),
                                extra=n % 250 == 12, file_id=n % 2, order=[n])
    assert len(_parts(path)) >= 15 and max(_parts(path)) < 150
    staged = csv_load.load_files(spark, path, SCHEMA, _scratch(), AT)
    bad = {i: "n: 'x7' is no int" for i in range(7, 1000, 100)} | {i: "wrong number of fields" for i in range(12, 1000, 250)}
    got = [(r.file_name, r.line_number, r.error) for r in csv_load.rejected(staged).collect()]
    assert sorted(got) == sorted((f"part-0000{i % 2}", i // 2 + 2, e) for i, e in bad.items())
    assert sorted(r.n for r in csv_load.loaded(staged).collect()) == sorted(set(range(1000)) - set(bad))
    audit = {r.file_name: (r.row_parsed, r.row_count, r.first_error_line_number) for r in csv_load.audit(staged, "t", AT).collect()}
    odd = sum(i % 2 for i in bad)
    assert audit == {"part-00000": (500, 500 - len(bad) + odd, 8), "part-00001": (500, 500 - odd, 5), "part-00002": (0, 0, None)}


def test_a_piece_may_begin_with_a_line_like_the_header(spark):
    """Only the first line of the first piece is the header."""
    folder = f"{_scratch()}/{csv_load.PIECES}=a.csv"
    os.makedirs(folder)
    for name, text in (("part-00003-x.c000.txt", "id,n\na,1\n"), ("part-00007-y.c000.txt", "id,n\nb,2\n"), ("part-100000-z.txt", "c,x\n")):
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    staged = csv_load.load_files(spark, os.path.dirname(folder), SCHEMA, _scratch(), AT)
    assert [(r.file_name, r.line_number, r.error) for r in csv_load.rejected(staged).orderBy("line_number").collect()] == \
        [("a.csv", 3, "n: 'n' is no int"), ("a.csv", 5, "n: 'x' is no int")]
    assert sorted((r.id, r.n) for r in csv_load.loaded(staged).collect()) == [("a", 1), ("b", 2)]


def test_one_distance_is_stored_by_many_tasks(spark, few_rows_a_file):
    rows = spark.range(1000).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("shipment_id"),
                                    F.when(F.col("id") < 900, 12.5).otherwise(F.col("id") / 10).alias("distance_km"))
    path = _scratch()
    marts.by_distance(rows).write.parquet(path)
    stored = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.min("distance_km").alias("lo"), F.max("distance_km").alias("hi")).orderBy("f").collect()
    assert sum(r.n for r in stored) == 1000 and max(r.n for r in stored) < 150
    assert all(a.hi <= b.lo for a, b in zip(stored, stored[1:], strict=False))


def test_only_the_staged_shipments_are_stored(spark, few_rows_a_file):
    """Checks derive the columns they need; nothing as large as a feed is written beside the
    staged shipments, whose buckets grow in number with the rows."""
    wh = Warehouse(spark, SF_SMALL, store_layers=True)
    for check in (monitoring.range_checks, monitoring.duplicate_keys, monitoring.orphans):
        assert check(wh).count() > 0
    assert set(os.listdir(shared_dir(spark, f"warehouse/{wh._run_id}").removeprefix("file:"))) == {"stg_shipments", "dim_vessel", "dim_carrier"}
    n = wh.stg_shipments.count()
    files_written = {r.f for r in wh.stg_shipments.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(files_written) >= n // 50 // 2


def test_a_run_joins_the_shipment_feed_once(spark):
    wh = Warehouse(spark, SF_SMALL)
    stored = wh.with_stored_feed()
    assert stored.raw_shipments._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    assert "Join" in wh.raw_shipments._jdf.queryExecution().executedPlan().toString()
    for of_run in (stored.raw_shipments, stored.stg_shipments, stored.latest_shipments):
        assert "Join" not in of_run._jdf.queryExecution().executedPlan().toString()
    assert stored.raw_shipments.exceptAll(wh.raw_shipments).isEmpty() and stored.raw_shipments.count() == wh.raw_shipments.count()
