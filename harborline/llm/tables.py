"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_root


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for one run's files under the shared checkpoint folder (not created)."""
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, and a lost executor costs no recomputation."""
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """As ``stored``, in fewer bytes: for whole texts."""
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (doc_id, text), a null text as the empty text: extra columns of any
    name cannot clash with the operators' own."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
