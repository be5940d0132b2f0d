"""Hard negatives against scoring every pair."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.llm import segment_mining


def plain(rows, is_anchor, n_positives=5, n_negatives=10, low=30, high=90):
    used = [(k, i, [math.floor(256 * x) for x in v], label) for k, (i, v, label) in enumerate(rows)
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def order(r):
        return -r[0], r[1] is None, r[1] or 0, r[2]
    out = []
    for k, i, v, label in used:
        if i is None or not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m, other) for m, j, w, other in used if m != k]
        for p in sorted((s for s in scored if s[3] == label), key=order)[:n_positives]:
            fits = sorted((s for s in scored if s[3] != label and low * p[0] <= 100 * s[0] <= high * p[0]), key=order)
            out += [(i, p[1], n + 1, s[1], p[0], s[0]) for n, s in enumerate(fits[:n_negatives])]
    return out


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows],
                                 "vec_id long, embedding array<float>, label int, row int, mean string").coalesce(1)
    return [tuple(r) for r in segment_mining.mine(spark, docs, F.col("vec_id") % 10 == 0, **options).collect()]


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("dim,block", [(64, 8192), (7, 3), (1, 5), (24, 8192)])
def test_equals_scoring_every_pair(spark, monkeypatch, dim, block):
    monkeypatch.setattr(segment_mining, "ANCHORS_PER_BLOCK", block)
    monkeypatch.setattr(segment_mining, "STRIPES", 3)
    monkeypatch.setattr(segment_mining, "CELLS", 100)
    g = np.random.default_rng(dim)
    centres = g.normal(0, 0.3, (4, dim))
    rows = []
    for i in range(220):
        label = int(g.integers(0, 4))
        v = centres[label] * float(g.uniform(0.2, 1.2)) + g.normal(0, 0.1, dim)
        rows.append((i, [float(np.float32(x)) for x in v], label))
    common = rows[5][1]
    rows += [(300 + i, common, i % 3) for i in range(60)]           # one very common vector, ties
    rows += [rows[10], rows[10], rows[20], (None, common, 1), (None, common, 2)]  # repeated rows, null ids
    rows += [(400, None, 1), (410, common, None), (420, [None] + common[1:], 1), (430, [float("nan")] + common[1:], 1),
             (440, [float("inf")] + common[1:], 1), (450, [], 1), (460, [0.0] * dim, 2)]
    if dim > 1:
        rows += [(470, common[:dim // 2], 1)]
    got, want = mined(spark, rows), plain(rows, lambda i: i % 10 == 0)
    assert want and sorted(got, key=key) == sorted(want, key=key)


def test_few_rows(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [0.5, 1.0], 1), (2, [0.3, 0.2], 2)]
    assert sorted(mined(spark, rows)) == sorted(plain(rows, lambda i: i % 10 == 0)) != []
    assert mined(spark, rows[1:]) == [] and mined(spark, rows[:1]) == []
    assert mined(spark, [(0, None, 1)]) == []
    rows = [(0, [-1.0], 1), (1, [1.0], 1), (2, [0.0], 2), (10, [0.0], 3), (11, [0.0], 3)]  # negative and zero scores
    assert sorted(mined(spark, rows), key=key) == sorted(plain(rows, lambda i: i % 10 == 0), key=key)


def test_bounds_hold_and_tighten():
    """Every level's bounds contain the exact score and are no wider than the level's before."""
    g = random.Random(3)
    for dim in (2, 5, 16, 64, 100):
        v = np.array([[g.choice([g.randint(-300, 300), 7]) for _ in range(dim)] for _ in range(60)], float)
        mean, deviation = segment_mining.summaries(v)
        exact, at, before = v @ v.T, 0, None
        for borders in segment_mining.edges(dim):
            w, n = np.sqrt(np.diff(borders)), len(borders) - 1
            m, s = mean[:, at:at + n] * w, deviation[:, at:at + n] * w
            at += n
            middle, off = m @ m.T, s @ s.T
            assert (np.abs(exact - middle) <= off + 1e-6).all()
            if before is not None:
                assert (off <= before + 1e-6).all()
            before = off


def test_filter_leaves_fewer_pairs(spark):
    """Vectors whose segments differ in their means are told apart without exact scores."""
    g = np.random.default_rng(1)
    v = np.repeat(g.normal(0, 100, (200, 4)), 16, 1).round() + g.integers(-3, 4, (200, 64))
    import pyarrow as pa
    mean, deviation = segment_mining.summaries(v)
    ids = pa.array(np.arange(200))
    rows = segment_mining.Rows(pa.record_batch([ids, ids, ids, segment_mining._lists(v), segment_mining._lists(mean),
                                                segment_mining._lists(deviation)],
                                               ["row", "vec_id", "label", "vector", "mean", "deviation"]))
    exact = v @ v.T
    low = np.sort(exact, 1)[:, -5]
    a, r, score = segment_mining.scores(rows, rows, low, np.full(200, np.inf), np.ones((200, 200), bool))
    assert (score == exact[a, r]).all() and len(a) < 4000
    assert np.count_nonzero(score >= low[a]) == np.count_nonzero(exact >= low[:, None])


def test_large_components_stay_exact(spark):
    rows = [(0, [3e6, 1.5], 1), (1, [2.9e6, 1.25], 1), (2, [1.5e6, 7.0], 2), (3, [2e6, -3.5], 2)]
    assert sorted(mined(spark, rows)) == sorted(plain(rows, lambda i: i % 10 == 0)) != []
    with pytest.raises(Exception, match="OverflowError"):
        mined(spark, [(0, [3e30], 1), (1, [3e30], 1), (2, [1.0], 2)])
