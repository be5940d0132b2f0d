"""The registered queries of this package: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bottom_k, byte_cnn, divergence_rules, external_shuffle, extendible_index, periodic_runs,
               segment_mining, simhash_lines, soft_mixing, unit_hashing, warc_chain, whole_token_counts, window_packing)
from .oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register
def op1_simhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_lines.fuzzy_line_groups(spark, table(spark, sf_dir, "documents"))


@register
def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_rules.divergence(spark, table(spark, sf_dir, "documents"))


@register
def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return soft_mixing.mix(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                           targets=(0.97, 0.02, 0.01))


@register
def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    scored = byte_cnn.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@register
def op5_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    packed = window_packing.pack(spark, table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                 added=window_packing.BYTE_BPE_50K_ADDED)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@register
def op6_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.near_duplicates(spark, table(spark, sf_dir, "documents"), shingle=3, percent=85)


@register
def op7_extendible_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_index.exact_duplicates(spark, table(spark, sf_dir, "documents"), every_row=True).drop("bucket", "chain")


@register
def op8_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_chain.read_archives(spark, warc_chain.write_archives(spark, table(spark, sf_dir, "pages")))


@register
def op9_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = external_shuffle.two_pass_shuffle(spark, table(spark, sf_dir, "documents"), n_shards=8)
    text = F.coalesce("record.text", F.lit(""))
    return shards.select("record.doc_id", external_shuffle.record_bytes("record`.`text").alias("size"),
                         F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@register
def op10_unit_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_hashing.repeated_units(spark, table(spark, sf_dir, "documents"), unit=unit_hashing.UNITS,
                                       min_words=5, min_stretch=20)


@register
def op11_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return whole_token_counts.count_tokens(spark, table(spark, sf_dir, "documents"),
                                           public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@register
def op12_segment_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return segment_mining.mine(spark, table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """One document in ten repeats a stretch of its words from a place on; a document
    without id stays as it is."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


@register
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(spark, table(spark, sf_dir, "documents"), reorder=looped, with_runs=False)
