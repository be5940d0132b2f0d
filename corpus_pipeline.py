"""Corpus pipeline: documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), applies one
operator to all documents that its predecessor kept, and returns the columns of
``documents`` (the last one returns pieces).  ``run`` writes each stage's rows as
Parquet in the shared folder and reads them again for the next.

Nulls, empty and repeated rows: see the operators.  A document whose id is null
or repeated is kept or dropped with the other rows of its id; of rows that
repeat id and text the exact-duplicate stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import bottom_k, divergence_rules, extendible_index, soft_mixing, window_packing
from harborline.llm.tables import stored

# expected token shares of good, low-quality and toxic text after mixing
TARGETS = (0.97, 0.02, 0.01)


def _rows(docs: DataFrame) -> DataFrame:
    """(id, row): all columns travel as one struct, so no name of theirs can clash."""
    return docs.select(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(id, row) of the rows whose id is in ``kept``."""
    rows, ids = _rows(docs), kept.select(F.col("doc_id").alias("kept_id")).distinct()
    return rows.join(ids, F.col("id").eqNullSafe(F.col("kept_id")), "left_semi")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the divergence rules keep."""
    return divergence_rules.only_kept(spark, docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    found = extendible_index.exact_duplicates(spark, docs)
    kept = _only(docs, found.filter("kept"))
    repeated = docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("repeated_id"))
    if not repeated.isEmpty():
        again = F.col("id").eqNullSafe(F.col("repeated_id"))
        kept = kept.join(repeated, again, "left_anti").unionByName(
            kept.join(repeated, again, "left_semi").withColumn("text", F.col("row.text"))
            .dropDuplicates(["id", "text"]).drop("text"))
    return kept.select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return _only(docs, bottom_k.near_duplicates(spark, docs, shingle=5, percent=80).filter("kept")).select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its rate to the target weights says."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    copies = (soft_mixing.mix(spark, docs, labels, TARGETS).filter("copies > 0")
              .groupBy(F.col("doc_id").alias("mixed_id")).agg(F.max("copies").alias("copies")))
    mixed = _rows(docs).join(copies, F.col("id").eqNullSafe(F.col("mixed_id")))
    return mixed.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    import public_tokenizers
    packed = window_packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                 added=window_packing.BYTE_BPE_50K_ADDED)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
