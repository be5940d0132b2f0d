"""Parquet tables whose every version is published by one rename (survey A12-A14).

A table is a set of immutable data folders and a log of snapshots, one small JSON
file per version that names the folders it consists of.  A run writes new folders
beside the old ones and then renames its snapshot file into place: the only step
that readers see.  A reader holds the folders its snapshot names, so it sees the
table before the run or after it, never a mixture; a run that breaks off before the
rename leaves the table as it was, and its folders are removed by ``vacuum``.

Two runs that start from the same version cannot both publish: a rename never
replaces a file, so the second one raises ``CommitConflict`` and has to be repeated.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StructType

from .broadcast import checked_broadcast
from .files import file_system, path_exists
from .latest import latest_per_key

DELTA_KEYS = 500_000                      # keys of a delta that are broadcast to the table; beyond, a shuffle join
RUN = "_run"                              # sub-folder of a partition that one run wrote
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class CommitConflict(RuntimeError):
    """Another run published the next version first."""


def _watermark(text: str | None):
    if text is None:
        return None
    return dt.datetime.fromisoformat(text) if "T" in text or ":" in text else dt.date.fromisoformat(text)


class SnapshotLog:
    """Numbered JSON files under ``path``; the highest number is the current snapshot."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        if not path_exists(self.spark, self.path):
            return []
        folder, fs = file_system(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != "_" and n[0] != ".")

    def read(self, version: int) -> dict:
        file, fs = file_system(self.spark, self._file(version))
        stream = fs.open(file)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def head(self) -> dict | None:
        versions = self.versions()
        return self.read(versions[-1]) if versions else None

    def has_tag(self, tag: str) -> bool:
        versions = self.versions()
        if not versions:
            return False
        tags = self.spark.read.schema("tag string").json([self._file(v) for v in versions])
        return not tags.filter(F.col("tag") == tag).isEmpty()

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:09d}.json"

    def commit(self, entry: dict, after: int) -> int:
        """Publish ``entry`` as the version after ``after``; raises ``CommitConflict``
        if there is one already."""
        entry = {**entry, "version": after + 1, "committed_at": dt.datetime.now(dt.timezone.utc).isoformat()}
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        written, fs = file_system(self.spark, f"{self.path}/_{uuid.uuid4().hex}.tmp")
        stream = fs.create(written)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        target = jvm.org.apache.hadoop.fs.Path(self._file(after + 1))
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
        try:
            context.rename(written, target, options)
        except Py4JJavaError as error:
            fs.delete(written, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise CommitConflict(f"version {after + 1} of {self.path} exists") from error
            raise
        return after + 1

    def forget(self, keep: int) -> list[dict]:
        """Remove all but the newest ``keep`` snapshots; returns the kept ones."""
        versions = self.versions()
        for v in versions[:-keep]:
            file, fs = file_system(self.spark, self._file(v))
            fs.delete(file, False)
        return [self.read(v) for v in versions[-keep:]]


def _observed(df: DataFrame, wm_col: str | None) -> tuple[DataFrame, Observation | None]:
    """``df`` with the maximum of its watermark column observed while it is written."""
    if wm_col is None:
        return df, None
    seen = Observation(f"wm_{uuid.uuid4().hex[:8]}")
    return df.observe(seen, F.max(wm_col).alias("wm")), seen


class _Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = SnapshotLog(spark, f"{self.path}/snapshots")

    def exists(self) -> bool:
        return self.log.head() is not None

    def version(self) -> int:
        """The current version; 0 before the first."""
        head = self.log.head()
        return head["version"] if head else 0

    def current(self) -> tuple[int, str] | None:
        head = self.log.head()
        return (head["version"], head["tag"]) if head else None

    def current_watermark(self):
        """``MAX`` of the watermark column in the current version (None if unknown)."""
        head = self.log.head()
        return _watermark(head["watermark"]) if head else None

    def has_tag(self, tag: str) -> bool:
        return self.log.has_tag(tag)

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once beside the table and read back; ``vacuum`` deletes it."""
        path = f"{self.path}/staging/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _sweep(self) -> None:
        folder, fs = file_system(self.spark, f"{self.path}/staging")
        fs.delete(folder, True)

    def _commit(self, head: dict | None, tag: str | None, watermark, **entry) -> int:
        entry |= {"tag": tag or uuid.uuid4().hex, "watermark": watermark.isoformat() if watermark is not None else None}
        return self.log.commit(entry, head["version"] if head else 0)

    def commit_unchanged(self, tag: str | None, **also) -> int:
        """A run that found nothing to do: the data stays; a tag or new inputs are logged."""
        head = self.log.head()
        if tag is None and all(head.get(k) == v for k, v in also.items()):
            return head["version"]
        return self.log.commit({**head, **also, "tag": tag or uuid.uuid4().hex}, head["version"])


class VersionedTable(_Table):
    """A table that every run writes whole."""

    def read(self) -> DataFrame | None:
        head = self.log.head()
        return self.spark.read.schema(StructType.fromJson(head["schema"])).parquet(head["data"]) if head else None

    def inputs(self) -> dict:
        """Versions of the source tables that the current version was built from."""
        head = self.log.head()
        return (head or {}).get("inputs") or {}

    def commit(self, df: DataFrame, tag: str | None = None, watermark_col: str | None = None,
               inputs: dict | None = None) -> int:
        """Publish ``df`` as the next version."""
        head = self.log.head()
        folder = f"{self.path}/v={(head['version'] if head else 0) + 1:06d}/run={uuid.uuid4().hex[:12]}"
        out, seen = _observed(df, watermark_col)
        out.write.parquet(folder)
        schema = self.spark.read.parquet(folder).schema
        return self._commit(head, tag, seen.get.get("wm") if seen else None, data=folder,
                            schema=schema.jsonValue(), inputs=inputs)

    def vacuum(self, keep: int = 2) -> None:
        """Delete what none of the newest ``keep`` versions needs.  Not while a run is writing."""
        self._sweep()
        needed = {e["data"] for e in self.log.forget(keep)}
        folder, fs = file_system(self.spark, self.path)
        for v in fs.listStatus(folder):
            if not v.getPath().getName().startswith("v="):
                continue
            name = f"{self.path}/{v.getPath().getName()}"
            runs = [s.getPath() for s in fs.listStatus(v.getPath())]
            for run in runs:
                if f"{name}/{run.getName()}" not in needed:
                    fs.delete(run, True)
            if not any(d.startswith(f"{name}/") for d in needed):
                fs.delete(v.getPath(), True)


class PartitionedTable(_Table):
    """A table partitioned by a coarse whole-number or date column (e.g. the month of
    departure), upserted by rewriting only the partitions that hold a delta row or a
    key the delta replaces.

    The rows to rewrite go to new folders ``data/<part>=<value>/_run=<run>``; the new
    snapshot takes these in place of the old folders of the touched partitions and
    keeps all others, which are neither read nor written.  The list of partitions is
    as long as the calendar.
    """

    def __init__(self, spark: SparkSession, path: str, partition_col: str):
        super().__init__(spark, path)
        self.part = partition_col

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table at a version (by default the current one)."""
        head = self.log.read(version) if version else self.log.head()
        return self._of(head, head["folders"].values()) if head else None

    def _of(self, entry: dict, folders) -> DataFrame:
        schema, folders = StructType.fromJson(entry["schema"]), list(folders)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
                .parquet(*[f"{self.path}/data/{f}" for f in folders]).select(*schema.names))

    def changed(self, since: int, until: int) -> DataFrame | None:
        """Rows that version ``until`` holds and version ``since`` did not, or the other
        way round (an updated row in both forms).  Only partitions whose folders differ are
        read; equal rows cancel out by their number."""
        then, now = self.log.read(since), self.log.read(until)
        differ = {f for f in {*then["folders"], *now["folders"]} if then["folders"].get(f) != now["folders"].get(f)}
        if not differ:
            return None
        old = self._of(then, [p for f, p in then["folders"].items() if f in differ])
        new = self._of(now, [p for f, p in now["folders"].items() if f in differ]).select(*old.columns)
        both = old.withColumn("__n", F.lit(-1)).unionByName(new.withColumn("__n", F.lit(1)))
        return (both.groupBy(*old.columns).agg(F.sum("__n").alias("__n"))
                .filter(F.col("__n") != 0).drop("__n"))

    def _write(self, df: DataFrame, wm_col: str | None) -> tuple[dict, dict, object]:
        """(partition folder -> this run's folder in it, schema, maximum of the watermark)."""
        if not isinstance(df.schema[self.part].dataType, (IntegralType, DateType)):
            raise ValueError(f"partition column {self.part} has to be a whole number or a date")
        run = uuid.uuid4().hex[:12]
        out, seen = _observed(df, wm_col)
        out.withColumn(RUN, F.lit(f"r{run}")).write.mode("append").partitionBy(self.part, RUN).parquet(f"{self.path}/data")
        root, fs = file_system(self.spark, f"{self.path}/data")
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        folders = {n: f"{n}/{RUN}=r{run}" for n in names
                   if n.startswith(f"{self.part}=") and fs.exists(jpath(f"{self.path}/data/{n}/{RUN}=r{run}"))}
        return folders, df.schema.jsonValue(), seen.get.get("wm") if seen else None

    def _folder(self, value) -> str:
        return f"{self.part}={NULL_FOLDER if value is None else value}"

    def overwrite(self, df: DataFrame, wm_col: str | None = None, tag: str | None = None) -> int:
        head = self.log.head()
        folders, schema, wm = self._write(df, wm_col)
        return self._commit(head, tag, wm, folders=folders, schema=schema)

    def upsert(self, delta: DataFrame, keys: list[str], order_cols: list[str],
               wm_col: str | None = None, tag: str | None = None) -> list:
        """Replace the delta's keys by their latest delta rows; rows with a null key are
        added.  Returns the partition values rewritten."""
        head = self.log.head()
        if head is None:
            self.overwrite(delta, wm_col, tag)
            return []
        target = self._of(head, head["folders"].values())
        has_key = F.lit(True)
        for k in keys:
            has_key = has_key & F.col(k).isNotNull()
        rows = self.scratch(latest_per_key(delta.filter(has_key), keys, order_cols).unionByName(delta.filter(~has_key)),
                            "delta")                                  # the delta is modelled once
        ids = checked_broadcast(rows.select(*keys).distinct(), DELTA_KEYS)
        moved = target.select(*keys, self.part).join(ids, keys, "left_semi")
        parts = [r[0] for r in moved.select(self.part).union(rows.select(self.part)).distinct().collect()]  # a calendar at most
        old_wm = _watermark(head["watermark"])
        if not parts:
            if tag is not None:
                self.commit_unchanged(tag)
        else:
            touched = {self._folder(p) for p in parts}
            kept = (self._of(head, [f for n, f in head["folders"].items() if n in touched])
                    .join(ids, keys, "left_anti").select(*target.columns))
            written, _, wm = self._write(kept.unionByName(rows.select(*target.columns)), wm_col)
            folders = {n: f for n, f in head["folders"].items() if n not in touched} | written
            wm = old_wm if wm is None or (old_wm is not None and old_wm > wm) else wm
            self._commit(head, tag, wm, folders=folders, schema=head["schema"])
        return parts

    def vacuum(self, keep: int = 2) -> None:
        """Delete what none of the newest ``keep`` versions needs.  Not while a run is writing."""
        self._sweep()
        needed = {f for e in self.log.forget(keep) for f in e["folders"].values()}
        root, fs = file_system(self.spark, f"{self.path}/data")
        for p in fs.listStatus(root):
            name = p.getPath().getName()
            if not name.startswith(f"{self.part}="):
                continue
            for run in fs.listStatus(p.getPath()):
                if f"{name}/{run.getPath().getName()}" not in needed:
                    fs.delete(run.getPath(), True)
            if not any(f.startswith(f"{name}/") for f in needed):
                fs.delete(p.getPath(), True)
