"""Runs of repeated words against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from harborline.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(x):
    """Every maximal stretch of every period, of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(words):
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


@pytest.mark.parametrize("pairs", [7, 100, 1 << 20])
def test_runs_equal_plain_search(monkeypatch, pairs):
    monkeypatch.setattr(periodic_runs, "PAIRS", pairs)
    g = random.Random(pairs)
    for _ in range(120):
        texts = []
        for _ in range(g.randint(1, 8)):
            n, k = g.choice([0, 1, 5, 6, 7, 30, 200, 500]), g.choice([1, 2, 2, 3, 5, 50])
            x = [g.randrange(k) for _ in range(n)]
            for _ in range(g.randint(0, 3) if n > 20 else 0):
                a = g.randrange(n)
                p = g.randint(1, max(1, (n - a) // g.randint(3, 9)))
                for i in range(a, min(n, a + p * g.randint(3, 10))):
                    x[i] = x[a + (i - a) % p]
            texts.append(np.array(x, np.int32))
        doc, runs = periodic_runs.find_runs(texts)
        for k, x in enumerate(texts):
            assert [tuple(r) for r in runs[doc == k].tolist()] == plain_runs(x.tolist())


def test_extensions_equal_plain_comparison():
    g = np.random.default_rng(4)
    for n, k in ((1, 1), (40, 1), (700, 2), (900, 1), (500, 400)):
        x = np.append(np.tile(g.integers(0, k, max(n // 3, 1)), 3)[:n], -1)
        ask = periodic_runs.Extensions(x)
        i, j = np.sort(g.integers(0, len(x), (2, 300)), 0)
        i, j = i[i < j], j[i < j]
        want = []
        for a, b in zip(i.tolist(), j.tolist()):
            m = 0
            while b + m < len(x) and x[a + m] == x[b + m]:
                m += 1
            want.append(m)
        assert ask(i, j).tolist() == want


def test_cover():
    assert (periodic_runs.cover_shifts(31, periodic_runs.COVER) < 31).all()
    with pytest.raises(ValueError):
        periodic_runs.cover_shifts(31, (0, 1, 3))


def test_texts_of_every_kind(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "PART_BYTES", 64)
    monkeypatch.setattr(periodic_runs, "SLICE_WORDS", 500)
    g = random.Random(9)
    texts = [None, "", " \n\t ", "a", "a a a a a", "a a a a a a", "x " + "a b " * 4 + "a y", "the cat " * 300, "\x1c a\x85b " * 9,
             "no run here at all", "é ☃ " * 7 + "end", "w" * 300 + " " + "p q r " * 40]
    texts += [" ".join(g.choices("abc", k=g.randint(0, 300))) for _ in range(60)]
    rows = [(None if i == 4 else i // 2, t, 1, "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, runs string").coalesce(1)
    got = periodic_runs.periodic_runs(spark, docs).collect()
    want = [(i, *plain_row(WORD.findall(t or ""))) for i, t, *_ in rows]
    key = str
    assert sorted([(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
                   for r in got], key=key) == sorted(want, key=key)
    by_id = {r.doc_id: r for r in got if r.doc_id == 3}
    assert [(x.start, x.length, x.period) for x in by_id[3].runs] in ([(1, 9, 2)], [(0, 600, 2)])
    assert periodic_runs.periodic_runs(spark, docs.limit(0)).collect() == []


def test_one_long_text():
    """A run over a million words, and two periods beside each other."""
    doc, runs = periodic_runs.find_runs([np.zeros(1_000_000, np.int32), np.tile(np.arange(3), 50_000),
                                         np.concatenate([np.zeros(999, int), np.tile([0, 1], 500)])])
    assert runs.tolist() == [[0, 1_000_000, 1], [0, 150_000, 3], [0, 1000, 1], [999, 1000, 2]]


def test_query_equals_plain_search(spark):
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    reordered = 0
    for i, text in docs:
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if n > 3000:
            continue  # the plain search is quadratic
        if h % 10 == 0 and n:
            g, reordered = h // 10, reordered + 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        assert got[i] == (i, *plain_row(words))
    assert reordered > 5
