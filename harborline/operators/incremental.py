"""Incremental materialisation: watermark filter + upsert by key (survey A13,
A14, M5, Z10, Z11), and marts kept by their dirty keys (A14, J17).

Parquet tables have no MERGE, so an upsert writes new files and publishes them as the
table's next snapshot (``operators.snapshots``): a reader never sees a half-written
version and a replayed micro-batch (same batch id) is skipped.  Writing the new
version cuts the lineage; nothing is cached on executors.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import lit_ntz
from .files import path_exists
from .latest import latest_per_key
from .snapshots import CommitConflict, PartitionedTable, VersionedTable  # noqa: F401


def watermark_value(target: DataFrame, col: str):
    """``SELECT MAX(col) FROM this`` as a literal (NULL for an empty table)."""
    return target.agg(F.max(col).alias("m")).first()["m"]


def watermark_filter(source: DataFrame, col: str, max_value, lookback: dt.timedelta | None = None,
                     date_lookback_days: int | None = None) -> DataFrame:
    """Rows newer than the target watermark: strict ``>``, as the reference.

    ``lookback`` (timestamps) / ``date_lookback_days`` (dates) move the bound
    back so late rows at or below the watermark are reprocessed (mode
    ``lookback=n``); the upsert then replaces the keys they touch.  An empty
    target (NULL watermark) lets nothing pass, like ``x > NULL``.
    """
    if max_value is None:
        return source.filter(F.lit(False))
    bound = max_value
    if lookback is not None:
        bound = max_value - lookback
    if date_lookback_days is not None:
        bound = max_value - dt.timedelta(days=date_lookback_days)
    lit = lit_ntz(bound) if isinstance(bound, dt.datetime) else F.lit(bound)
    return source.filter(F.col(col) > lit)


def upsert(target: DataFrame, delta: DataFrame, keys: list[str],
           order_cols: list[str] | None = None) -> DataFrame:
    """New table version: target rows whose key is not in the delta, plus the
    delta reduced to its latest row per key (``order_cols``).  Rows with a
    NULL key never match (as in SQL) and pass through unchanged."""
    order_cols = order_cols or ["_loaded_at"]
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    d_keyed = latest_per_key(delta.filter(has_key), keys, order_cols)
    d_null = delta.filter(~has_key)
    kept = target.join(d_keyed.select(*keys).distinct(), keys, "left_anti").select(*target.columns)
    return kept.unionByName(d_keyed).unionByName(d_null)


def run_incremental(table: VersionedTable, build, source: DataFrame, keys: list[str],
                    wm_col: str = "_loaded_at", full_refresh: bool = False,
                    lookback: dt.timedelta | None = None, tag: str | None = None) -> int | None:
    """One scheduled run of an incremental model.

    ``build(source_rows) -> DataFrame`` is the model.  First run or
    ``full_refresh``: the model over all source rows.  Later runs: the model
    over source rows newer than ``MAX(wm_col)`` of the current version (or
    within ``lookback`` of it), upserted by ``keys``.  A run whose ``tag`` is
    already committed is skipped (idempotent replay); returns the version.
    """
    if tag is not None and table.has_tag(tag):
        return None
    cur = None if full_refresh else table.read()
    if cur is None:
        return table.commit(build(source), tag, wm_col)
    mx = table.current_watermark()
    if mx is None:                       # table written without a stored watermark
        mx = watermark_value(cur, wm_col)
    newer = watermark_filter(source, wm_col, mx, lookback)
    if newer.isEmpty():                  # nothing to do: the stored version stays
        return table.commit_unchanged(tag)
    return table.commit(upsert(cur, build(newer), keys, [wm_col]), tag, wm_col)


def run_incremental_mart(table: VersionedTable, build, wm_col: str, keys: list[str],
                         full_refresh: bool = False) -> int:
    """One run of a mart whose watermark is its own key date.  ``build(after,
    stored)`` is the mart past ``after``, given the stored mart; both are None on the
    first run and on a full refresh."""
    cur = None if full_refresh else table.read()
    if cur is None:
        return table.commit(build(None, None), watermark_col=wm_col)
    delta = table.scratch(build(table.current_watermark(), cur), "delta")
    if delta.isEmpty():
        return table.commit_unchanged(None)
    return table.commit(upsert(cur, delta, keys, [wm_col]), watermark_col=wm_col)


def run_by_dirty_keys(table: VersionedTable, sources: dict[str, PartitionedTable], keys: list[str],
                      dirty: Callable[[str, DataFrame], DataFrame],
                      build: Callable[[DataFrame | None, dict[str, DataFrame], DataFrame | None], tuple],
                      full_refresh: bool = False, tag: str | None = None) -> int | None:
    """One run of a mart that follows its sources' changes, late and corrected rows included.

    The mart's log keeps the versions of the ``sources`` it was built from.  The rows that
    changed since then (``PartitionedTable.changed``) give, by ``dirty(name, rows)``, the
    mart keys they touch.  ``build(dirty keys, source rows, stored mart)`` returns (keys to
    replace, their new rows) and reads no more than these need; with None as keys, on the
    first run and on a full refresh, it returns (None, the whole mart).  A key without a new
    row goes.  The sources are read at one version each, whatever other runs publish
    meanwhile.  Returns the version (None: ``tag`` was committed before)."""
    if tag is not None and table.has_tag(tag):
        return None
    now = {name: s.version() for name, s in sources.items()}
    rows = {name: s.read(now[name]) for name, s in sources.items()}
    cur, built_from = table.read(), table.inputs()
    known = all(built_from.get(name) in s.log.versions() for name, s in sources.items())
    if cur is None or full_refresh or not known:
        return table.commit(build(None, rows, None)[1], tag, inputs=now)
    touched = None
    for name, source in sources.items():
        changed = source.changed(built_from[name], now[name]) if built_from[name] != now[name] else None
        if changed is not None:
            of_source = dirty(name, changed).select(*keys)
            touched = of_source if touched is None else touched.unionByName(of_source)
    if touched is None:
        return table.commit_unchanged(tag, inputs=now)
    seen = table.scratch(touched.distinct(), "dirty")
    if seen.isEmpty():
        return table.commit_unchanged(tag, inputs=now)
    stale, fresh = build(seen, rows, cur)
    both = [cur[k].eqNullSafe(stale[k]) for k in keys]
    return table.commit(cur.join(stale, both, "left_anti").unionByName(fresh.select(*cur.columns)), tag, inputs=now)


class ChangelogTable:
    """Append-only change log for streaming sinks.

    Each micro-batch writes only its own rows into its own folder (overwritten
    if the batch is replayed, so the sink is idempotent); readers fold the log
    with a latest-row-per-key partial aggregate (later batch wins, then the
    ``order_cols``).  A batch costs O(its rows), not O(table)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.bases = VersionedTable(spark, f"{self.path}/base")

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        (df.withColumn("_batch", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(f"{self.path}/batch_{batch_id:010d}"))

    def read_all(self) -> DataFrame:
        """The newest compacted base (if any) plus the batches after it."""
        batches = self.spark.read.parquet(f"{self.path}/batch_*")
        cur = self.bases.current()
        if cur is None:
            return batches
        upto = int(cur[1].split("-")[1])
        base = self.bases.read().select(*batches.columns)
        return base.unionByName(batches.filter(F.col("_batch") > upto))

    def compact(self, keys: list[str], order_cols: list[str] | None = None) -> int:
        """Fold the log into a new base (latest row per key), so readers scan
        the base plus only the batches written after it."""
        log = self.read_all()
        upto = log.agg(F.max("_batch")).first()[0]
        if upto is None:
            return -1
        has_key = F.lit(True)
        for k in keys:
            has_key = has_key & F.col(k).isNotNull()
        folded = latest_per_key(log.filter(has_key), keys, ["_batch"] + (order_cols or []))
        self.bases.commit(folded.unionByName(log.filter(~has_key)), tag=f"upto-{upto}")
        return upto

    def read_latest(self, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
        log = self.read_all()
        has_key = F.lit(True)
        for k in keys:
            has_key = has_key & F.col(k).isNotNull()
        keyed = latest_per_key(log.filter(has_key), keys, ["_batch"] + (order_cols or []))
        return keyed.unionByName(log.filter(~has_key)).drop("_batch")


class PaneLog(ChangelogTable):
    """A change log of sums: each micro-batch adds its rows' sums per key, and readers
    add the batches up, so batches may hold rows of any time."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], sums: list[str]):
        super().__init__(spark, path)
        self.keys, self.sums = keys, sums

    def _summed(self, log: DataFrame) -> DataFrame:
        return log.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.sums])

    def read_sums(self) -> DataFrame:
        return self._summed(self.read_all())

    def newest(self, col: str, before_batch: int):
        """The largest ``col`` of the batches before this one (None: there is none)."""
        if not before_batch or not path_exists(self.spark, self.path):
            return None
        return self.read_all().filter(F.col("_batch") < before_batch).agg(F.max(col)).first()[0]

    def compact_sums(self) -> int:
        """Add the log up into a new base, so readers scan it plus the batches written after it."""
        log = self.read_all()
        upto = log.agg(F.max("_batch")).first()[0]
        if upto is None:
            return -1
        self.bases.commit(self._summed(log).withColumn("_batch", F.lit(upto).cast("long")), tag=f"upto-{upto}")
        return upto


def run_incremental_partitioned(table: PartitionedTable, build, source: DataFrame, keys: list[str],
                                wm_col: str = "_loaded_at", lookback: dt.timedelta | None = None,
                                tag: str | None = None, full_refresh: bool = False) -> list | None:
    """``run_incremental`` on a partitioned table: the delta rewrites only the
    partitions it touches."""
    if tag is not None and table.has_tag(tag):
        return None
    if full_refresh or not table.exists():
        table.overwrite(build(source), wm_col, tag)
        return []
    newer = watermark_filter(source, wm_col, table.current_watermark(), lookback)
    if newer.isEmpty():                  # nothing to do: nothing is modelled or written
        table.commit_unchanged(tag)
        return []
    return table.upsert(build(newer), keys, [wm_col], wm_col, tag)
