"""Pipeline stages and extra columns that bear the operators' own names."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
NAMES = ["_lang", "_ref_lang", "_reference", "_LANG_", "mixed_id", "mixed_copies", "mixed_copy", "copies", "repeated_id",
         "kept_id", "kept", "id", "row", "col", "h", "bucket", "cell", "keep_id", "key", "n", "sketch", "first", "linked",
         "named", "component_id", "tokens", "rate", "gap", "pos", "label", "class_shares", "word_distance"]


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.unionByName(docs.filter("doc_id < 5"))      # repeated rows
    for name in NAMES:
        more = more.withColumn(name, F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = stage(spark, docs, SF).select("doc_id").distinct()
        got = stage(spark, more, SF)
        assert got.columns == more.columns, name
        wrong = [F.col(f"`{n}`") != F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")) for n in NAMES]
        for condition in wrong:
            assert got.filter(condition).isEmpty(), name
        if name == "exact_dedup":
            assert sorted(map(tuple, got.select("doc_id").collect())) == sorted(map(tuple, plain.collect())), name
