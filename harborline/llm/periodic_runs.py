"""Runs of repeated words by longest common extensions over a difference cover.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least max(``MIN_WORDS``, ``MIN_EXPONENT`` x q) words long, that neither
neighbouring word extends keeping period q.

1. Harmonic grid: the words x of a run with x[i] == x[i + q] are a stretch of at
   least 3q places, so it holds a multiple of 3q.  Only the pairs (i, i + q) at these
   places are asked: about n/3 ln n for n words, over all periods.
2. A few words on either side are compared first.  A document in which no pair
   agrees on as many words as a run needs has no run and is done.
3. Otherwise a pair's exact extension is the longest common extension of i and i + q,
   forwards in the words and backwards in the reversed words.  Only suffixes at
   positions of a difference cover modulo 31 are sorted (6 of 31): their first 31
   words, then by doubling.  For any two positions a shift below 31 brings both into
   the cover; the words before it are compared directly, the rest is a range minimum
   over the sorted suffixes' common prefixes, from a sparse table.
4. Of equal stretches the smallest period stays.  Pairs inside a known run whose
   period divides theirs are not asked again.

``periodic_runs`` works document by document inside tasks, with no shuffle.  Small
documents share numpy arrays of about ``SLICE_WORDS`` words; each ends in a word of its
own, so nothing extends across.  A long text is split into words in parts of
``PART_BYTES``, and its pairs are asked ``PAIRS`` at a time.  Memory is about 60 bytes
a word of one text, not of a task.

Result: one row per row of ``docs``: doc_id, n_runs, start, length, period and
exponent_milli of the longest run (ties: smallest start, then period; none: nulls),
runs (all, by start, then period) when ``with_runs``, runs_sha256 (their
``start,length,period`` lines), collapsed_sha256 (the words left when every word of a
run after its first period goes, joined by one blank).  Null, empty and blank texts
have no word and no run; their digests are those of the empty string.  Repeated ids
are rows of their own.  Other columns of ``docs`` are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_WORDS, MIN_EXPONENT = 6, 4
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
FEW = 8                  # words compared on either side before any sorting
SLICE_WORDS = 1 << 18    # words of small documents worked on together
PART_BYTES = 1 << 20
PAIRS = 1 << 20          # grid pairs asked at a time
BLANK = re.compile(rb"[\x20\x09-\x0D]")
SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs array<struct<start:long,length:long,period:long>>, runs_sha256 string, collapsed_sha256 string")


def cover_shifts(modulus: int, cover: tuple[int, ...]) -> np.ndarray:
    """For two residues the smallest shift that brings both into the cover."""
    inside = np.isin(np.arange(2 * modulus) % modulus, cover)
    k = np.arange(modulus)
    both = inside[k[:, None, None] + k] & inside[k[None, :, None] + k]
    if not both.any(2).all():
        raise ValueError(f"{cover} is no difference cover of {modulus}")
    return both.argmax(2)


SHIFTS = cover_shifts(MODULUS, COVER)
SLOT = np.full(MODULUS, -1)
SLOT[list(COVER)] = np.arange(len(COVER))


class Extensions:
    """Longest common extensions of pairs i < j of one document in ``x``, where every
    document ends in a value that occurs once."""

    def __init__(self, x: np.ndarray):
        self.x, n, d = x, len(x), len(COVER)
        at = (np.arange(0, n, MODULUS)[:, None] + np.array(COVER)).ravel()
        at = at[at < n]
        m = len(at)
        low, width = int(x.min()), int(x.max()) - int(x.min()) + 1
        rank = np.zeros(m, np.int64)
        for k in range(MODULUS):
            rank = np.unique(rank * width + (x[np.minimum(at + k, n - 1)] - low), return_inverse=True)[1]
            if int(rank.max()) == m - 1:
                break
        levels = [rank.astype(np.int32)]
        while int(rank.max()) < m - 1:
            step = d << (len(levels) - 1)
            following = np.zeros(m, np.int64)
            following[:m - step] = rank[step:] + 1
            rank = np.unique(rank * (m + 1) + following, return_inverse=True)[1]
            levels.append(rank.astype(np.int32))
        self.rank = levels[-1]
        order = np.argsort(self.rank)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(m - 1, 0), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            ranks, step = levels[level], d << level
            same = np.flatnonzero((ranks[np.minimum(a, m - 1)] == ranks[np.minimum(b, m - 1)]) & (a < m) & (b < m))
            a[same] += step
            b[same] += step
            common[same] += MODULUS << level
        del levels
        here, there = at[order[:-1]] + common, at[order[1:]] + common
        go = np.arange(len(common))
        while len(go):
            go = go[(here[go] < n) & (there[go] < n)]
            go = go[x[here[go]] == x[there[go]]]
            here[go] += 1
            there[go] += 1
            common[go] += 1
        tables = [common.astype(np.int32)]
        while 2 << (len(tables) - 1) <= len(common):
            last, half = tables[-1], 1 << (len(tables) - 1)
            tables.append(np.minimum(last[:-half], last[half:]))
        self.minima = tables

    def _sampled(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        d = len(COVER)
        a, b = (self.rank[at // MODULUS * d + SLOT[at % MODULUS]] for at in (p, q))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.zeros(len(p), np.int64)
        for k in np.unique(level):
            here = np.flatnonzero(level == k)
            table = self.minima[k]
            out[here] = np.minimum(table[low[here]], table[high[here] - (1 << int(k))])
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        need = SHIFTS[i % MODULUS, j % MODULUS]
        same = agreeing(self.x, i, j, need)
        synced = np.flatnonzero(same == need)
        same[synced] += self._sampled(i[synced] + need[synced], j[synced] + need[synced])
        return same


def agreeing(x: np.ndarray, i: np.ndarray, j: np.ndarray, at_most: np.ndarray, step: int = 1) -> np.ndarray:
    """How many words agree from i and j on, compared one by one up to a limit."""
    same = np.zeros(len(i), np.int64)
    go, k = np.flatnonzero(at_most > 0), 0
    while len(go):
        go = go[x[i[go] + step * k] == x[j[go] + step * k]]
        k += 1
        same[go] = k
        go = go[at_most[go] > k]
    return same


def grid(first: np.ndarray, n: np.ndarray, skip: Callable | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, i, period) of the grid pairs, by period; documents are given by the
    places of their first words and their numbers of words."""
    periods = np.where(n >= MIN_WORDS, n // MIN_EXPONENT, 0)
    doc = np.repeat(np.arange(len(n)), periods)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    by_period = np.argsort(q, kind="stable")
    doc, q = doc[by_period], q[by_period]
    until = np.cumsum((n[doc] + 2 * q - 1) // (3 * q))
    total = int(until[-1]) if len(until) else 0
    for lo in range(0, total, PAIRS):
        pair = np.arange(lo, min(lo + PAIRS, total))
        row = np.searchsorted(until, pair, "right")
        before = until[row] - (n[doc[row]] + 2 * q[row] - 1) // (3 * q[row])
        d, p = doc[row], q[row]
        yield d, first[d] + (pair - before) * 3 * p, p


def _few(x: np.ndarray, i: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Indices of the pairs that agree on as many of a few words as a run needs."""
    at = np.flatnonzero(x[i] == x[i + q])
    i, q = i[at], q[at]
    cap = np.full(len(at), FEW)
    both = agreeing(x, i, i + q, cap) + agreeing(x, i - 1, i + q - 1, cap, -1)
    return at[both >= np.minimum(np.maximum(MIN_WORDS - q, (MIN_EXPONENT - 1) * q), FEW)]


def _unasked(i: np.ndarray, q: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Indices of the pairs that lie in no known run whose period divides theirs."""
    long = found[found[:, 1] >= int(q.min()) + found[:, 2]] if len(i) else found[:0]
    if not len(long):
        return np.arange(len(i))
    long = long[np.argsort(long[:, 0], kind="stable")]
    end = long[:, 0] + long[:, 1]
    furthest = np.maximum.accumulate(np.where(end == np.maximum.accumulate(end), np.arange(len(end)), 0))
    run = np.searchsorted(long[:, 0], i, "right") - 1
    run = np.where(run >= 0, furthest[run], 0)
    start, length, p = long[run].T
    inside = (start <= i) & (i + q < start + length) & (q % p == 0) & (length >= p + q)
    return np.flatnonzero(~inside)


def find_runs(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(document, [start, length, period]) of all runs of several documents, given as
    arrays of word numbers (not negative), by document, start and period."""
    def joined(chosen: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.array([len(texts[c]) for c in chosen], np.int64)
        first = np.cumsum(n + 1) - n
        x = np.empty(int(n.sum()) + len(n) + 1, np.int64)
        x[0], x[first + n] = -1, -2 - np.arange(len(n))
        for f, c in zip(first, chosen):
            x[f:f + len(texts[c])] = texts[c]
        return x, first, n
    none = np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    if not texts:
        return none
    x, first, n = joined(list(range(len(texts))))
    doubtful = np.zeros(len(texts), bool)
    for d, i, q in grid(first, n):
        open_ = np.flatnonzero(~doubtful[d])
        doubtful[d[open_[_few(x, i[open_], q[open_])]]] = True
    chosen = np.flatnonzero(doubtful)
    if not len(chosen):
        return none
    x, first, n = joined(chosen.tolist())
    forwards, backwards = Extensions(x), Extensions(x[::-1].copy())
    found = none[1]
    for _, i, q in grid(first, n):
        ask = _few(x, i, q)
        ask = ask[_unasked(i[ask], q[ask], found)]
        i, q = i[ask], q[ask]
        back = backwards(len(x) - i - q, len(x) - i)
        length = back + forwards(i, i + q) + q
        run = np.flatnonzero(length >= np.maximum(MIN_WORDS, MIN_EXPONENT * q))
        found = np.concatenate([found, np.stack([i - back, length, q], 1)[run]])
        found = found[np.lexsort(found.T[::-1])]  # by start, length, period
        found = found[np.flatnonzero(np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(1)])[:len(found)])]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    d = np.searchsorted(first, found[:, 0], "right") - 1
    found[:, 0] -= first[d]
    return chosen[d], found


class _Numbers(dict):
    """word -> its number, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _word_numbers(text: bytes, numbers: _Numbers) -> np.ndarray:
    parts, at = [np.zeros(0, np.int32)], 0
    while at < len(text):
        blank = BLANK.search(text, min(at + PART_BYTES, len(text)))
        end = blank.start() if blank else len(text)
        words = text[at:end].split()  # bytes split at just these six
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        at = end
    return np.concatenate(parts)


def _collapsed(words: np.ndarray, of: np.ndarray, runs: np.ndarray) -> str:
    change = np.zeros(len(of) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = of[np.cumsum(change[:-1]) == 0] if len(runs) else of
    digest = hashlib.sha256()
    for lo in range(0, len(kept), SLICE_WORDS):
        digest.update((b" " if lo else b"") + b" ".join(words[kept[lo:lo + SLICE_WORDS]].tolist()))
    return digest.hexdigest()


def _rows(texts: list[np.ndarray], words: np.ndarray, with_runs: bool) -> Iterator[tuple]:
    doc, found = find_runs(texts)
    border = np.searchsorted(doc, np.arange(len(texts) + 1))
    for k, of in enumerate(texts):
        runs = found[border[k]:border[k + 1]]
        listed = runs.tolist()
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in listed)
        best = min(listed, key=lambda r: (-r[1], r[0], r[2])) if listed else None
        yield (len(listed), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
               [dict(zip(("start", "length", "period"), r)) for r in listed] if with_runs else None,
               hashlib.sha256(lines.encode()).hexdigest(), _collapsed(words, of, runs))


def periodic_runs(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  reorder: Callable[[int | None, int], np.ndarray | None] | None = None,
                  with_runs: bool = True) -> DataFrame:
    """Runs of every text of ``docs``; see the module text.  ``reorder(doc_id, n)`` may
    give the positions whose words make up the text to look at instead (None: as it is)."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")),
                            ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                            ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])

        def worked(ids, texts, numbers):
            words = np.empty(len(numbers), object)
            words[:] = list(numbers)
            rows = list(zip(ids, *zip(*_rows(texts, words, with_runs))))
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        for batch in batches:
            ids, texts, numbers, total = [], [], _Numbers(), 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id = doc_id.as_py()
                of = _word_numbers((text.as_py() or "").encode(), numbers)
                order = reorder(doc_id, len(of)) if reorder else None
                ids.append(doc_id)
                texts.append(of if order is None else of[order])
                total += len(of)
                if total >= SLICE_WORDS:
                    yield worked(ids, texts, numbers)
                    ids, texts, numbers, total = [], [], _Numbers(), 0
            if ids:
                yield worked(ids, texts, numbers)
    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    out = chosen.mapInArrow(found, SCHEMA)
    return out if with_runs else out.drop("runs")
