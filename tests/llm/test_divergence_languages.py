"""Rare languages are measured by their own words, or not at all."""

from __future__ import annotations

import numpy as np

from harborline.llm import divergence_rules


def text(g, stem, n):
    """A text of a language: few common words, many rare ones."""
    return " ".join(f"{stem}{i}" if i < 40 else f"{stem}{int(g.integers(40, 900))}"
                    for i in np.minimum(g.geometric(0.06, n), 60).tolist())


def test_rare_languages_keep_their_clean_documents(spark):
    g = np.random.default_rng(8)
    rows = [(i, text(g, "w", 30), "en") for i in range(45_000)]
    rows += [(100_000 + i, text(g, "der", 400), "de") for i in range(40)]
    rows += [(200_000 + i, text(g, "que", 400), "fr") for i in range(20)]
    rows += [(300_000 + i, text(g, "los", 400), "es") for i in range(2)]
    rows += [(400_000, text(g, "w", 400), "fr"), (400_001, text(g, "w", 400), None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in divergence_rules.divergence(spark, d).filter("doc_id >= 100000").collect()}
    assert all(r.kept for i, r in got.items() if i < 400_000)
    assert not got[400_000].kept and got[400_000].word_distance > divergence_rules.MAX_WORD  # another language's words
    assert got[300_000].word_distance == 0 and got[400_001].kept  # too few words to measure by
    kept = divergence_rules.only_kept(spark, d).filter("doc_id >= 100000")
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept} and kept.columns == d.columns
