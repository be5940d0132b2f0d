"""Largest-remainder shares and the latest row per key against plain Python."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

from harborline.operators.allocation import share_out
from harborline.operators.latest import latest_per_key, latest_rows


def plain_shares(cents, parts):
    """{tie: cents} by largest remainders; parts are (weight in cents, fallback, tie)."""
    weights = {tie: w for w, _, tie in parts}
    if not any(weights.values()):
        weights = {tie: n for _, n, tie in parts}
    total = sum(weights.values())
    exact = {tie: Fraction(cents * w, total) for tie, w in weights.items()}
    out = {tie: int(x) for tie, x in exact.items()}
    order = sorted(exact, key=lambda tie: (out[tie] - exact[tie], tie is None, tie or ""))
    for tie in order[:cents - sum(out.values())]:
        out[tie] += 1
    return out


def test_shares_add_up_to_the_cent(spark):
    g = random.Random(8)
    rows, want = [], {}
    for k in range(120):
        cents = g.choice([0, 1, 99, 100, 10 ** 9 + 7, g.randrange(10 ** 7)])
        ties = g.sample(["a", "b", "c", "d", "e", None], g.randint(1, 6))
        zero = g.random() < 0.2
        parts = [(0 if zero else g.choice([0, 1, 333, g.randrange(10 ** 6)]), g.randint(1, 4), tie) for tie in ties]
        shares = plain_shares(cents, parts)
        assert sum(shares.values()) == cents
        for w, n, tie in parts:
            rows.append((f"g{k}", Decimal(cents) / 100, Decimal(w) / 100, n, tie))
            want[f"g{k}", tie] = Decimal(shares[tie]) / 100
    df = spark.createDataFrame(rows, "g string, amount decimal(22,2), weight decimal(25,2), n long, tie string")
    got = {(r.g, r.tie): r.share for r in share_out(df, "g", "amount", "weight", "n", "tie").collect()}
    assert got == want


def test_latest_rows_equal_latest_per_key(spark):
    g = random.Random(4)
    rows = [(g.choice(["a", "b", "c", None]), g.choice([1, 2, 3, None]), g.choice(["x", "y", None]), g.randint(0, 2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, at int, name string, n int")
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append(tuple((x is not None, x if x is not None else 0) if i < 2 else (x is not None, str(x or "")) if i == 2 else (True, x)
                                for i, x in enumerate(r)))
    one, other = (sorted(map(tuple, f(df, ["k"], ["at"]).collect()), key=str) for f in (latest_rows, latest_per_key))
    assert one == other and len(one) == 4
    for k, at, name, n in one:
        assert max(want[k]) == ((k is not None, k if k is not None else 0), (at is not None, at or 0), (name is not None, str(name or "")), (True, n))
