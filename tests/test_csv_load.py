"""Header-driven CSV load: line numbers in split files, rejects, audit and history."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest

from harborline.sources import bronze_csv, csv_load
from harborline.sources.schemas import _ddl

SCHEMA = _ddl("id string, n int, amount decimal(15,2), _loaded_at timestamp_ntz")
AT = dt.datetime(2026, 5, 4, 3, 2, 1)


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


@pytest.fixture()
def folder():
    return tempfile.mkdtemp() + "/csv"


def _staged(spark, folder, **options):
    return csv_load.load_files(spark, folder, SCHEMA, tempfile.mkdtemp() + "/staged", AT, **options)


def test_line_numbers_hold_in_split_files(spark, folder):
    """Every 97th line is bad; the files are cut into dozens of splits."""
    want = []
    for k in range(3):
        lines = ["id,n,amount"]
        for i in range(2, 3001 + 100 * k):
            bad = i % 97 == 0
            lines.append(f"r{k}-{i},{'x' if bad else i},{i}.50" + ",more" * (i % 194 == 0))
            if bad:
                want.append((f"f{k}.csv", i, "wrong number of fields" if i % 194 == 0 else "n: 'x' is no int"))
        _write(folder, f"f{k}.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        staged = _staged(spark, folder)
        assert staged.select("_place.file", "_place.block").distinct().count() > 50
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    got = [(r.file_name, r.line_number, r.error) for r in csv_load.rejected(staged).collect()]
    assert sorted(got) == sorted(want)
    audit = {r.file_name: r for r in csv_load.audit(staged, "t", AT).collect()}
    assert [audit[f"f{k}.csv"].first_error_line_number for k in range(3)] == [97, 97, 97]
    assert sum(a.row_parsed for a in audit.values()) == 2999 + 3099 + 3199
    assert csv_load.loaded(staged).count() == sum(a.row_count for a in audit.values()) == 9297 - len(want)


def test_columns_by_header(spark, folder):
    _write(folder, "a.csv", "﻿Amount, ID ,extra_col,n\n1.25,a,zzz,7\nNULL,\"b, \"\"q\"\"\",,null\n")
    _write(folder, "b.csv", "ident,_loaded_at\nc,2026-01-01 00:00:00\n\n  \nd,\n")
    _write(folder, "only_header.csv", "n,id\n")
    _write(folder, "empty.csv", "")
    staged = _staged(spark, folder, aliases={"Ident": "id"})
    got = {r.id: (r.n, r.amount and float(r.amount), r._loaded_at) for r in csv_load.loaded(staged).collect()}
    assert got == {"a": (7, 1.25, AT), 'b, "q"': (None, None, AT),
                   "c": (None, None, dt.datetime(2026, 1, 1)), "d": (None, None, None)}
    audit = {r.file_name: (r.row_parsed, r.row_count, r.status, r.last_load_time) for r in csv_load.audit(staged, "t", AT).collect()}
    assert audit == {"a.csv": (2, 2, "LOADED", AT), "b.csv": (2, 2, "LOADED", AT), "only_header.csv": (0, 0, "LOADED", AT)}
    assert csv_load.rejected(staged).count() == 0


def test_a_line_that_repeats_the_header_is_a_row(spark, folder):
    _write(folder, "a.csv", "id\nx\nid\ny\n")
    path = tempfile.mkdtemp() + "/staged"
    n = csv_load.stage(csv_load.text_lines(spark.read.text(folder)), _ddl("id string"), path, AT)
    assert n == 3 and sorted(r.id for r in csv_load.loaded(spark.read.parquet(path)).collect()) == ["id", "x", "y"]


def test_headers_that_do_not_fit_raise(spark, folder):
    _write(folder, "a.csv", "foo,bar\n1,2\n")
    with pytest.raises(ValueError):
        _staged(spark, folder)
    _write(folder, "a.csv", "id,id\n1,2\n")
    with pytest.raises(ValueError):
        _staged(spark, folder)


def test_no_files(spark, folder):
    os.makedirs(folder)
    staged = _staged(spark, folder)
    assert csv_load.loaded(staged).count() == csv_load.rejected(staged).count() == csv_load.audit(staged, "t", AT).count() == 0


def test_ingest_keeps_rejects_and_history(spark, folder):
    root = tempfile.mkdtemp()
    target, ckpt = f"{root}/bronze", f"{root}/ckpt"
    _write(folder, "one.csv", "id,n\na,1\nb,two\n")

    def ingest(at):
        return bronze_csv.ingest_files(spark, folder, SCHEMA, target, ckpt, "raw_t", at)
    assert ingest(AT) == 1
    _write(folder, "two.csv", "n,id\n3,c\n4,d\n")
    assert ingest(AT + dt.timedelta(days=20)) == 2 and ingest(AT) == 0
    assert sorted((r.id, r.n) for r in bronze_csv.read_ingested(spark, target).collect()) == [("a", 1), ("c", 3), ("d", 4)]
    assert [(r.file_name, r.line_number, r.error) for r in bronze_csv.read_rejected(spark, target).collect()] == \
        [("one.csv", 3, "n: 'two' is no int")]
    history = bronze_csv.load_history(spark, target)
    assert sorted((r.table_name, r.file_name, r.row_count, r.status) for r in history.collect()) == \
        [("raw_t", "one.csv", 1, "PARTIALLY_LOADED"), ("raw_t", "two.csv", 2, "LOADED")]
    recent = csv_load.recent_loads(history, AT + dt.timedelta(days=21)).collect()
    assert [r.file_name for r in recent] == ["two.csv"]
