"""Tables published by snapshots: what readers see while a run writes, breaks off or
loses a race, and marts that follow the rows that changed."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from harborline.operators.incremental import (CommitConflict, PartitionedTable, VersionedTable, run_by_dirty_keys,
                                              run_incremental_partitioned)

DDL = "id string, v int, m int"


def _path(name="t"):
    return os.path.join(tempfile.mkdtemp(), name)


def _rows(df):
    return sorted((r.id, r.v, r.m) for r in df.collect())


@pytest.fixture()
def table(spark):
    t = PartitionedTable(spark, _path(), "m")
    t.overwrite(spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 1, 2), ("d", 1, 3)], DDL))
    return t


def test_reader_during_the_swap_sees_one_version(spark, table, monkeypatch):
    """A key moves from month 1 to month 2: a reader never sees it twice or not at all."""
    seen = []
    commit = table.log.commit

    def watched(entry, after):
        held = PartitionedTable(spark, table.path, "m").read()   # planned before the rename, run after it
        seen.append(_rows(held))
        version = commit(entry, after)
        seen.append(_rows(held))
        seen.append(_rows(PartitionedTable(spark, table.path, "m").read()))
        return version
    monkeypatch.setattr(table.log, "commit", watched)
    table.upsert(spark.createDataFrame([("a", 2, 2)], DDL), ["id"], ["v"])
    old = [("a", 1, 1), ("b", 1, 1), ("c", 1, 2), ("d", 1, 3)]
    assert seen == [old, old, [("a", 2, 2), ("b", 1, 1), ("c", 1, 2), ("d", 1, 3)]]


def test_a_run_that_breaks_off_leaves_the_old_version(spark, table, monkeypatch):
    before = _rows(table.read())
    delta = spark.createDataFrame([("a", 2, 2), ("e", 2, 4)], DDL)

    def broken(entry, after):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(table.log, "commit", broken)
        with pytest.raises(OSError):
            table.upsert(delta, ["id"], ["v"])
    assert _rows(table.read()) == before and table.version() == 1
    table.upsert(delta, ["id"], ["v"])
    assert _rows(table.read()) == [("a", 2, 2), ("b", 1, 1), ("c", 1, 2), ("d", 1, 3), ("e", 2, 4)]
    table.vacuum(keep=1)                      # the folders of the broken run go
    folders = [f for p in os.listdir(f"{table.path}/data") if p.startswith("m=") for f in os.listdir(f"{table.path}/data/{p}")]
    assert len(folders) == 4 and _rows(table.read())[0] == ("a", 2, 2)


def test_second_of_two_runs_from_one_version_raises(spark, table, monkeypatch):
    other = PartitionedTable(spark, table.path, "m")
    write = table._write

    def overtaken(df, wm_col):
        out = write(df, wm_col)
        other.upsert(spark.createDataFrame([("d", 5, 3)], DDL), ["id"], ["v"])
        return out
    monkeypatch.setattr(table, "_write", overtaken)
    with pytest.raises(CommitConflict):
        table.upsert(spark.createDataFrame([("c", 9, 2)], DDL), ["id"], ["v"])
    assert _rows(other.read()) == [("a", 1, 1), ("b", 1, 1), ("c", 1, 2), ("d", 5, 3)]


def test_untouched_partitions_keep_their_files(spark, table):
    before = table.log.head()["folders"]
    assert table.upsert(spark.createDataFrame([("c", 2, 2)], DDL), ["id"], ["v"]) == [2]
    after = table.log.head()["folders"]
    assert {k for k in after if after[k] != before[k]} == {"m=2"}
    assert _rows(table.read(1)) == [("a", 1, 1), ("b", 1, 1), ("c", 1, 2), ("d", 1, 3)]


def test_changed_rows(spark, table):
    table.upsert(spark.createDataFrame([("a", 2, 1), ("c", 1, 2), ("e", 1, None)], DDL), ["id"], ["v"])
    assert sorted(map(tuple, table.changed(1, 2).select("id", "v", "m").collect())) == [("a", 1, 1), ("a", 2, 1), ("e", 1, None)]
    assert table.changed(2, 2) is None


def test_empty_tables_and_partition_types(spark):
    t = PartitionedTable(spark, _path(), "m")
    assert t.read() is None and t.current() is None and t.version() == 0
    t.overwrite(spark.createDataFrame([], DDL))
    assert t.read().count() == 0 and t.read().columns == ["id", "v", "m"]
    t.upsert(spark.createDataFrame([("a", 1, 7)], DDL), ["id"], ["v"])
    assert _rows(t.read()) == [("a", 1, 7)]
    with pytest.raises(ValueError):
        PartitionedTable(spark, _path(), "id").overwrite(spark.createDataFrame([("a", 1, 7)], DDL))


def test_versioned_table_vacuum(spark):
    t = VersionedTable(spark, _path())
    for i in range(4):
        t.commit(spark.createDataFrame([(i,)], "x int"), f"run-{i}")
    t.vacuum(keep=2)
    assert sorted(x for x in os.listdir(t.path) if x.startswith("v=")) == ["v=000003", "v=000004"]
    assert t.read().first().x == 3 and t.current() == (4, "run-3") and t.has_tag("run-2") and not t.has_tag("run-0")


def test_replayed_tag_and_empty_delta_write_nothing(spark):
    t = PartitionedTable(spark, _path(), "m")
    at = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz")
    source = spark.createDataFrame([("a", 1, 1)], DDL).withColumn("_loaded_at", at)
    assert run_incremental_partitioned(t, lambda r: r, source, ["id"], tag="one") == []
    assert run_incremental_partitioned(t, lambda r: r, source, ["id"], tag="one") is None
    assert run_incremental_partitioned(t, lambda r: 1 / 0, source, ["id"]) == []    # the model is not called
    assert t.version() == 1


def test_mart_by_dirty_keys_models_these_only(spark, table):
    """Per id: a late row, a moved row and a row that goes change three keys; the fourth
    is not modelled again."""
    mart, asked = VersionedTable(spark, _path("mart")), []

    def build(keys, rows, stored):
        of = rows["t"]
        if keys is not None:
            asked.append(sorted(r.id for r in keys.collect()))
            of = of.join(keys, "id", "left_semi")
        return keys, of.groupBy("id").agg(F.sum("v").alias("total"))

    def run():
        return run_by_dirty_keys(mart, {"t": table}, ["id"], lambda name, rows: rows, build)
    assert run() == 1 and run() == 1 and asked == []
    table.upsert(spark.createDataFrame([("a", 7, 3), ("late", 2, 1)], DDL), ["id"], ["v"])
    run()
    assert asked == [["a", "late"]]
    assert sorted(map(tuple, mart.read().collect())) == [("a", 7), ("b", 1), ("c", 1), ("d", 1), ("late", 2)]
    table.overwrite(table.read().filter("id <> 'b'"))
    run()
    assert sorted(map(tuple, mart.read().collect())) == [("a", 7), ("c", 1), ("d", 1), ("late", 2)]
    table.vacuum(keep=1)                       # the version the mart was built from is gone: built anew
    table.upsert(spark.createDataFrame([("c", 4, 2)], DDL), ["id"], ["v"])
    table.vacuum(keep=1)
    assert run() and ("c", 4) in map(tuple, mart.read().collect())
