"""Near-duplicates whose ids repeat or are null: components follow the texts."""

from __future__ import annotations

from harborline.llm import bottom_k


def _words(seed, n=60):
    return [f"w{seed}x{i}" for i in range(n)]


def test_repeated_and_null_ids(spark):
    w, v, u = (" ".join(_words(s)) for s in "wvu")
    rows = [(1, w), (1, v), (2, w + " x"), (3, v + " y"),     # both texts of row 1 are linked with another row
            (None, u), (7, u + " z"), (None, "only null here " * 9), (8, "alone " + " ".join(_words("q")))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = bottom_k.near_duplicates(spark, docs, shingle=3, percent=85).collect()
    components = {}
    for r in got:
        components.setdefault(r.doc_id, set()).add(r.component_id)
    assert components == {1: {1}, 2: {1}, 3: {1}, 7: {7}, 8: {8}, None: {7, None}}
    assert {r.doc_id for r in got if r.kept} == {1, 7, 8, None}
