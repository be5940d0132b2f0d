"""Packing: long runs of one character, and where cuts lie."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from harborline.llm import window_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokens():
    return window_packing.Tokens(P.path("byte_bpe_50k.tiktoken"), P.PATTERN, window_packing.BYTE_BPE_50K_ADDED)


def test_long_runs_have_the_librarys_ids(tokens):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    g = random.Random(7)
    for text in (" " * 3_000_000, "a" * 100_000, "ab " * 10 + " " * 50_000 + "x<|endoftext|>" + "\n" * 30_000 + "end",
                 "".join(g.choices("abcdefgh", k=60_000)) + " tail", "é" * 40_000, "-" * 50_000 + "\t" * 25_000 + "'s"):
        assert list(tokens.ids(text)) == library.encode(text, add_special_tokens=False).ids


def test_pack_takes_long_runs(spark):
    docs = spark.createDataFrame([(1, "one. two. " + " " * 1_000_000 + "three."), (2, "x" * 300_000)], "doc_id long, text string")
    got = window_packing.pack(spark, docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert {r.doc_id for r in got} == {1, 2} and max(r.length for r in got) <= 1024


def test_windows_end_after_documents_and_sentences(spark, tokens):
    """Only a sentence longer than a window is cut inside."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("text IS NOT NULL").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    places, overlong = {}, {}
    for i, text in texts.items():
        ids, marks = window_packing.sentence_tokens(text, tokens, 0)
        borders = np.concatenate([[0], marks, [len(ids)]])
        places[i] = set(borders.tolist())
        overlong[i] = [(a, b) for a, b in zip(borders[:-1], borders[1:]) if b - a > 1024]
    got = window_packing.pack(spark, docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN,
                              added=window_packing.BYTE_BPE_50K_ADDED).collect()
    for r in got:
        end = r.start + r.length
        assert end in places[r.doc_id] or any(a < end < b for a, b in overlong[r.doc_id])
    filled = sum(r.length for r in got) / (1024 * len({r.sequence_id for r in got}))
    assert filled > 0.95
