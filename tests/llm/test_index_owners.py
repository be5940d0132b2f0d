"""Exact dedup goes through its directory and its owners' key ranges."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from harborline.llm import extendible_index

SF = "/root/testdata/sf0.001"


def test_documents_of_a_bucket_that_is_gone_are_not_found(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = extendible_index.exact_duplicates(spark, docs, capacity=20)
    buckets = [r.bucket for r in whole.select("bucket").distinct().collect()]
    assert len(buckets) > 5
    build = extendible_index.build_directory

    def without_one(*args):
        directory, bits = build(*args)
        return directory.filter(F.col("bucket") != buckets[0]), bits
    monkeypatch.setattr(extendible_index, "build_directory", without_one)
    left = extendible_index.exact_duplicates(spark, docs, capacity=20)
    gone = whole.filter(F.col("bucket") == buckets[0]).count()
    assert gone > 0 and left.count() == whole.count() - gone


def test_owners_group_without_another_shuffle(spark, monkeypatch):
    """From the range exchange on, the plan of the index has no other exchange."""
    plans = []
    stored = extendible_index.stored

    def watched(spark, df, name):
        if name == "index":
            text = io.StringIO()
            with contextlib.redirect_stdout(text):
                df.explain()
            plans.append(text.getvalue())
        return stored(spark, df, name)
    monkeypatch.setattr(extendible_index, "stored", watched)
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    extendible_index.exact_duplicates(spark, docs)
    above = plans[0][:plans[0].index("rangepartitioning(bucket")]
    assert above.count("Exchange") == 1 and above.count("HashAggregate") >= 1
    assert "Window" in above and "Python" not in plans[0]


def test_colliding_hashes_are_chained(spark):
    """With 4-bit hashes many different texts share one: bytes tell them apart."""
    texts = [f"text {i // 3}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = extendible_index.exact_duplicates(spark, docs, capacity=10, hash_bits=4).collect()
    assert all(r.keep_id == 3 * (r.doc_id // 3) + 2 and r.group_size == 3 for r in got) and len(got) == 300
    assert max(r.chain for r in got) >= 5
