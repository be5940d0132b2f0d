"""The fit of the mixing rates against plain projected gradient, and the query's gap."""

from __future__ import annotations

import numpy as np
import pytest

from harborline.llm import queries, soft_mixing

SF = "/root/testdata/sf0.001"


def measured(p, t):
    def sums(steps):
        r = soft_mixing._replay(p, steps)
        return t.sum(), (r * t) @ p / t.sum(), p.T @ (p * (t * (r > 0))[:, None]) / t.sum()
    return sums


def plain_gap(p, t, goal, rounds=20_000):
    """What many small projected gradient steps reach."""
    r, total = np.ones(len(p)), t.sum()
    share = (r * t) @ p / total
    weight = 1 / np.maximum(share, 1e-6)
    step = 1 / np.linalg.eigvalsh(np.sqrt(weight)[:, None] * (p.T @ (p * t[:, None]) / total) * np.sqrt(weight)).max()
    for _ in range(rounds):
        r = np.maximum(0, r - step * p @ (weight * (share - goal)))
        share = (r * t) @ p / total
    return np.abs(share - goal).max()


@pytest.mark.parametrize("seed", range(12))
def test_fit_reaches_what_plain_descent_reaches(seed):
    g = np.random.default_rng(seed)
    n, k = 300, int(g.integers(2, 6))
    p = g.dirichlet(np.full(k, g.choice([0.1, 0.5, 2.0])), n)
    t = g.integers(0, 2000, n).astype(float)
    goal = g.dirichlet(np.ones(k)) * g.choice([0.5, 1.0, 1.3])
    steps, gap = soft_mixing.fit(measured(p, t), goal)
    r = soft_mixing._replay(p, steps)
    assert (r >= 0).all() and np.isclose(gap, np.abs((r * t) @ p / t.sum() - goal).max())
    plain = plain_gap(p, t, goal)
    if plain < 1e-3:
        assert gap <= soft_mixing.TOLERANCE
    else:       # no rates reach these targets
        assert gap < 2 * plain + 0.01


def test_targets_out_of_reach_are_reported():
    p = np.array([[1.0, 0.0]] * 5)      # nothing belongs to the second domain
    steps, gap = soft_mixing.fit(measured(p, np.ones(5)), np.array([0.5, 0.5]))
    assert np.isclose(gap, 0.5) and np.allclose(soft_mixing._replay(p, steps), 0.5, atol=1e-3)


def test_query_meets_its_targets(spark):
    got = queries.QUERIES["op3_soft_mixing"](spark, SF).toPandas()
    p = got[["p_good", "p_low", "p_toxic"]].to_numpy()
    share = (got.rate * got.tokens).to_numpy() @ p / got.tokens.sum()
    assert np.abs(share - (0.97, 0.02, 0.01)).max() <= soft_mixing.TOLERANCE + 1e-9
    assert np.allclose(got.gap, np.abs(share - (0.97, 0.02, 0.01)).max(), atol=1e-9)
