"""Exact deduplication through an extendible-hash index on shared files.

1. One scan writes the key table: doc_id, 64-bit hash, SHA-256, byte length.
2. The directory starts as one bucket.  Every bucket that holds more distinct
   hashes than ``capacity`` is split by its next hash bit, and the directory
   doubles, until none is overfull.  The counts come from a histogram of hash
   cells, so a round touches only that small table.
3. Copies are folded before they are dealt out, in ``SALTS`` parts of each text, so a
   text with any number of copies reaches its owner as a few rows.
4. The index: every folded row finds its bucket in the directory, and owner tasks take
   ranges of (bucket, hash).  An owner gathers its keys' rows by comparing the texts
   themselves, byte by byte; equal hashes with different bytes become separate
   links of that hash's chain.  The index is written as the owners leave it.
5. Every document finds its bucket in the directory, and in it its entry by (hash,
   SHA-256, length).

Result: one row per document: doc_id, keep_id (the largest doc_id with this
text), group_size (rows with this text), kept, text_sha256, bucket, chain (link
in its hash's chain, from 0).

A null text counts as empty, and empty texts are equal to one another.  Rows that
repeat both id and text are one document (each counts in group_size), unless
``every_row`` asks for a row each.  A null id
never wins against another id.  An empty table gives an empty result.  Two
different texts with one SHA-256 would raise instead of being merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import id_and_text, stored

CAPACITY = 50_000
SMALL_DIRECTORY = 1 << 16  # cells; 16 bytes each when broadcast
SALTS = 8


def _hash(hash_bits: int) -> Column:
    h = F.xxhash64("text")
    return h if hash_bits == 64 else F.shiftleft(h, 64 - hash_bits)


def build_directory(spark: SparkSession, hashes: DataFrame, capacity: int = CAPACITY
                    ) -> tuple[DataFrame, int]:
    """Directory over the distinct values of ``hashes.h``: (cell, bucket, depth),
    one row per non-empty cell of the returned number of leading bits.  ``bucket``
    is the bucket's first cell, so buckets are ranges of the hash."""
    distinct = hashes.distinct()
    n = distinct.count()
    bits = max(6, min(40, (max(n, 1) // capacity).bit_length() + 6))
    cells = stored(spark, distinct.groupBy(F.shiftrightunsigned("h", 64 - bits).alias("cell"))
                   .agg(F.count(F.lit(1)).alias("n")), "cells")
    open_cells, done, depth = cells, None, 0
    while True:
        bucket = F.shiftleft(F.shiftright("cell", bits - depth), bits - depth)
        in_bucket = open_cells.withColumn("bucket", bucket)
        size = in_bucket.groupBy("bucket").agg(F.sum("n").alias("size"))
        sized = stored(spark, in_bucket.join(size, "bucket"), "directory")
        full = F.col("size") > capacity if depth < bits else F.lit(False)
        ready = sized.filter(~full).select("cell", "bucket", F.lit(depth).alias("depth"))
        done = ready if done is None else done.unionByName(ready)
        open_cells = sized.filter(full).select("cell", "n")
        if depth == bits or open_cells.isEmpty():
            return stored(spark, done, "directory"), bits
        depth += 1


def exact_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text", capacity: int = CAPACITY, hash_bits: int = 64,
                     every_row: bool = False) -> DataFrame:
    """Index ``docs`` and look every document up; see the module text."""
    d = id_and_text(docs, id_col, text_col).withColumn("h", _hash(hash_bits))
    keys = stored(spark, d.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"),
                                  F.octet_length("text").alias("n_bytes")), "keys")
    directory, bits = build_directory(spark, keys.select("h"), capacity)
    if directory.count() <= SMALL_DIRECTORY:
        directory = F.broadcast(directory)
    cell = F.shiftrightunsigned("h", 64 - bits)

    def in_bucket(rows: DataFrame) -> DataFrame:
        return rows.withColumn("cell", cell).join(directory, "cell").drop("cell", "depth")

    folded = (d.groupBy("h", "text", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).drop("salt"))
    # the owners' ranges serve the grouping and the chains as well: no other shuffle follows
    owned = (in_bucket(folded).repartitionByRange("bucket", "h").groupBy("bucket", "h", "text")
             .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    chain = Window.partitionBy("bucket", "h").orderBy("text_sha256", "n_bytes")
    index = stored(spark, owned.select("bucket", "h", F.sha2("text", 256).alias("text_sha256"),
                                       F.octet_length("text").alias("n_bytes"), "keep_id", "group_size")
                   .withColumn("chain", F.row_number().over(chain) - 1), "index")
    if not index.groupBy("h", "text_sha256", "n_bytes").count().filter("count > 1").isEmpty():
        raise ValueError("different texts share hash and SHA-256; they cannot be told apart")

    members = keys if every_row else keys.dropDuplicates(["doc_id", "h", "text_sha256"])
    return (in_bucket(members).join(index, ["bucket", "h", "text_sha256", "n_bytes"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256", "bucket", "chain"))
