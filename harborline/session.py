"""SparkSession construction and shared-storage locations."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  Time columns are timestamp_ntz throughout, so
# the zone only matters for display; UTC keeps logs unambiguous.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "harborline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Actions inside run wide projections in methods that the JVM compiles: it interprets
    methods of more than 8000 bytes, which a stage of many columns exceeds as one method."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session may leave it unset: then a private folder under the
    system temp dir is registered, so ``checkpoint()`` works the same way.  On
    a cluster each executor has a disk of its own, so an unset folder raises.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and "
                               "executors share; machine-local folders do not work here")
        root = tempfile.mkdtemp(prefix="harborline-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint folder; Spark's writers create it."""
    return f"{shared_root(spark)}/{name}"
