"""Paths in any Hadoop file system, and the number of files of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_FILE = 500_000     # rows that one task sorts and writes


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, the file system that holds it)."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own file system, local or not."""
    hadoop_path, fs = file_system(spark, path)
    return fs.exists(hadoop_path)


def file_count(df: DataFrame, least: int = 1) -> int:
    """How many files ``df`` is written to: no task sorts or writes more than about
    ``ROWS_PER_FILE`` rows, however large the table is."""
    return max(least, -(-df.count() // ROWS_PER_FILE))
