"""Hard negatives by inner product, filtered by segment summaries.

Every vector is cut into 1, 4, 16, ... segments.  For each segment its mean and its
deviation are stored beside the vector.  Over a segment of width w

    x . y  lies within  w * (mean x * mean y  +-  deviation x * deviation y),

and the sums over the segments bound the whole score from both sides.  A pair is
looked at with one segment first, then with 4, 16, ...; only pairs whose bounds still
reach what is asked for are scored exactly.

1. ``prepared``: components become floor(``scale`` * x); shorter vectors are filled
   with zeros.  The table with its summaries is stored.
2. Anchors are dealt into blocks of about ``ANCHORS_PER_BLOCK``, all rows into
   ``STRIPES`` stripes, and a task takes one block against one stripe.  Rows stream past
   the block in Arrow batches, so a task holds one block, one batch and the best rows
   so far, whose scores raise the bound for those to come.  A row is sent once for
   each block: the query set grows with the table, so this work is quadratic by
   nature.  Each task hands over its best rows only, and these meet by anchor.
3. ``positives``: the best rows of the anchor's label.  ``mine``: for each anchor and
   positive, the best rows of other labels whose score is between ``low`` and ``high``
   percent of the positive's.

Higher scores come first, then smaller ids (a null id last), then the order of the
stored table.  Rows with a null label, a null vector, or a null or non-finite
component take no part.  A null id is no anchor.  Repeated rows and ids are rows of
their own; a row is never its own positive.  Empty vectors score 0.  Scores are exact
integers; one that no long holds raises OverflowError.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import stored

ANCHORS_PER_BLOCK = 8192
STRIPES = 16
CELLS = 1 << 22   # pairs bounded at a time
DENSE = 16        # pairs are listed one by one when fewer than one in so many is left
LISTED = 1 << 16  # listed pairs at a time
NO_ID = MOST = np.iinfo(np.int64).max
ROW = "row long, vec_id long, label long, vector array<double>, mean array<double>, deviation array<double>"
BEST = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, row long, vec_id long, score long"


def edges(dim: int) -> list[np.ndarray]:
    """Segment borders of every level, coarse to fine."""
    return [np.linspace(0, dim, s + 1).astype(int) for s in (4 ** k for k in range(16)) if 2 * s <= dim]


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all segments of all levels, side by side."""
    means, deviations = [np.zeros((len(vectors), 0))], [np.zeros((len(vectors), 0))]
    for borders in edges(vectors.shape[1]):
        for lo, hi in zip(borders[:-1], borders[1:]):
            means.append(vectors[:, lo:hi].mean(1, keepdims=True))
            deviations.append(vectors[:, lo:hi].std(1, keepdims=True))
    return np.concatenate(means, 1), np.concatenate(deviations, 1)


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column, filled with zeros up to ``width``."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    width = width if width is not None else int(sizes.max(initial=0))
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return out


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), pa.float64()))


def prepared(spark: SparkSession, rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """The rows that take part, quantised, with their summaries (columns of ``ROW``)."""
    x = F.col("vector")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    used = (rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
            .filter(F.col("label").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(False))))
    dim = used.agg(F.max(F.size("vector"))).first()[0] or 0

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.floor(scale * _matrix(batch.column("vector"), dim))
            if np.abs(v).max(initial=0) >= 2.0 ** 63:
                raise OverflowError("a component does not fit in a long")
            mean, deviation = summaries(v)
            yield pa.record_batch([batch.column("row"), batch.column("vec_id"), batch.column("label"),
                                   _lists(v), _lists(mean), _lists(deviation)],
                                  ["row", "vec_id", "label", "vector", "mean", "deviation"])
    numbered = used.withColumn("row", F.monotonically_increasing_id())
    return stored(spark, numbered.mapInArrow(quantised, ROW), "vectors")


class Rows:
    """Columns of some rows as arrays; levels[k] = (means, deviations), each weighted by
    the square root of its segment's width, so products are plain inner products."""

    def __init__(self, batch: pa.RecordBatch):
        self.row = batch.column("row").to_numpy(zero_copy_only=False)
        self.id = batch.column("vec_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.label = batch.column("label").to_numpy(zero_copy_only=False)
        self.vector = _matrix(batch.column("vector"))
        mean, deviation = _matrix(batch.column("mean")), _matrix(batch.column("deviation"))
        self.levels, at = [], 0
        for borders in edges(self.vector.shape[1]):
            weight, n = np.sqrt(np.diff(borders)), len(borders) - 1
            self.levels.append((mean[:, at:at + n] * weight, deviation[:, at:at + n] * weight))
            at += n
        self.norm = float(np.sqrt((self.vector ** 2).sum(1)).max(initial=0))

    def part(self, chosen: slice) -> Rows:
        out = object.__new__(Rows)
        out.row, out.id, out.label, out.vector = (c[chosen] for c in (self.row, self.id, self.label, self.vector))
        out.levels, out.norm = [(m[chosen], s[chosen]) for m, s in self.levels], self.norm
        return out


def scores(anchors: Rows, rows: Rows, low: np.ndarray, high: np.ndarray, asked: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, exact score) of the ``asked`` pairs whose bounds meet their anchor's
    range of scores; ``asked`` is anchors x rows."""
    slack = 1e-9 * anchors.norm * rows.norm + 1e-6  # rounding of the bounds
    low, high = low - slack, high + slack
    pairs = None

    def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if pairs is None:
            return x @ y.T
        out = np.empty(len(pairs[0]))
        for at in range(0, len(out), LISTED):
            a, r = (p[at:at + LISTED] for p in pairs)
            out[at:at + LISTED] = np.einsum("ij,ij->i", x[a], y[r])
        return out

    for (mean_a, dev_a), (mean_r, dev_r) in zip(anchors.levels, rows.levels):
        middle, off = inner(mean_a, mean_r), inner(dev_a, dev_r)
        if pairs is None:
            asked = asked & (middle + off >= low[:, None]) & (middle - off <= high[:, None])
            if np.count_nonzero(asked) * DENSE < asked.size:
                pairs = np.nonzero(asked)
        else:
            left = (middle + off >= low[pairs[0]]) & (middle - off <= high[pairs[0]])
            pairs = pairs[0][left], pairs[1][left]
    if anchors.norm * rows.norm < 2.0 ** 52:  # doubles hold every sum on the way exactly
        found = inner(anchors.vector, rows.vector)
        if pairs is None:
            pairs = np.nonzero(asked)
            found = found[pairs]
        return *pairs, found.astype(np.int64)
    a, r = pairs or np.nonzero(asked)
    exact = [sum(int(p) * int(q) for p, q in zip(anchors.vector[i], rows.vector[j])) for i, j in zip(a, r)]
    return a, r, np.array(exact, object).astype(np.int64)


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` of every group: high scores, small ids, early rows."""
    order = np.lexsort((row, ids, -score, group))
    g = group[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])[:len(g)])
    place = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
    return order[place < k]


class Search:
    """The best rows of every group of one block of anchors, while rows stream past.

    A group is an anchor with one range of scores.  ``same`` asks for rows of the
    anchor's label, otherwise for rows of the others."""

    def __init__(self, anchors: Rows, owner: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.anchors, self.owner, self.low, self.high, self.k, self.same = anchors, owner, low, high, k, same
        self.group, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))
        self.first = np.searchsorted(owner, np.arange(len(anchors.row) + 1))  # groups are in the order of owners

    def floor(self) -> np.ndarray:
        """The least score that can still enter each group."""
        count = np.bincount(self.group, minlength=len(self.owner))
        least = np.full(len(self.owner), MOST)
        np.minimum.at(least, self.group, self.score)
        return np.where(count >= self.k, np.maximum(least, self.low), self.low)

    def look(self, rows: Rows) -> None:
        n = max(1, CELLS // max(len(self.anchors.row), 1))
        for at in range(0, len(rows.row), n):
            self._look(rows.part(slice(at, at + n)))

    def _look(self, rows: Rows) -> None:
        floor, a = self.floor(), self.anchors
        low, high = np.full(len(a.row), MOST), np.full(len(a.row), -MOST)
        np.minimum.at(low, self.owner, floor)
        np.maximum.at(high, self.owner, self.high)
        asked = (a.label[:, None] == rows.label) == self.same
        if self.same:
            asked &= a.row[:, None] != rows.row
        anchor, row, score = scores(a, rows, low, high, asked & (low <= high)[:, None])
        groups = np.diff(self.first)[anchor]  # every pair goes to each group of its anchor
        pair = np.repeat(np.arange(len(anchor)), groups)
        group = self.first[anchor[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(groups) - groups, groups)
        score, row = score[pair], row[pair]
        fits = np.flatnonzero((score >= floor[group]) & (score <= self.high[group]))
        group, score, row = group[fits], score[fits], row[fits]
        columns = [np.concatenate(c) for c in ((self.group, group), (self.score, score),
                                               (self.id, rows.id[row]), (self.row, rows.row[row]))]
        kept = best(*columns, self.k)
        self.group, self.score, self.id, self.row = (c[kept] for c in columns)


def _searched(start: Callable[[pa.Table], tuple[Search, list[np.ndarray]]]):
    """A mapInArrow function over partitions sorted by (cell, candidate): the anchors of
    a cell come first and open its search, its rows follow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, opening, search = None, [], None

        def opened():
            return start(pa.Table.from_batches(opening).combine_chunks())

        def result(search, names) -> pa.RecordBatch:
            found = [names[0][search.group], names[1][search.group], names[2][search.group], names[3][search.group],
                     names[4][search.group], search.row, search.id, search.score]
            masks = {3: found[3] == NO_ID, 6: found[6] == NO_ID}
            return pa.record_batch([pa.array(c, pa.int64(), mask=masks.get(k)) for k, c in enumerate(found)],
                                   [f.split()[0] for f in BEST.split(", ")])
        for batch in batches:
            cells = batch.column("cell").to_numpy(zero_copy_only=False)
            kinds = batch.column("candidate").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), len(cells)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if cells[lo] != cell:
                    if search:
                        yield result(*search)
                    cell, opening, search = cells[lo], [], None
                part = batch.slice(lo, hi - lo)
                if not kinds[lo]:
                    opening.append(part)
                elif opening:
                    search = search or opened()
                    search[0].look(Rows(part))
        if search:
            yield result(*search)
    return run


def _against_all(rows: DataFrame, anchors: DataFrame, blocks: int, run) -> DataFrame:
    """Every block of anchors against every stripe of rows, each in a task of its own."""
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    opening = (anchors.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(STRIPES - 1))))
               .withColumn("cell", (block * STRIPES + F.col("stripe")).cast("int")).drop("stripe")
               .withColumn("candidate", F.lit(False)))
    stripe = F.pmod(F.xxhash64(F.col("row"), F.lit("stripe")), F.lit(STRIPES))
    passing = (rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
               .withColumn("cell", (F.col("block") * STRIPES + stripe).cast("int")).drop("block")
               .withColumn("candidate", F.lit(True)))
    both = opening.unionByName(passing, allowMissingColumns=True)
    return (both.repartitionById(blocks * STRIPES, F.col("cell"))
            .sortWithinPartitions("cell", "candidate").mapInArrow(run, BEST))


def _first(found: DataFrame, k: int, *group: str) -> DataFrame:
    """The first ``k`` of every group, with their rank."""
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(spark: SparkSession, rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.  ``is_anchor`` is a condition on the
    column vec_id.  See the module text."""
    table = prepared(spark, rows, id_col, vector_col, label_col, scale)
    anchors = table.filter(is_anchor)
    blocks = max(1, -(-anchors.count() // ANCHORS_PER_BLOCK))

    def for_positives(opening: pa.Table):
        a = Rows(opening.to_batches()[0])
        n = np.arange(len(a.row))
        every = Search(a, n, np.full(len(n), -MOST), np.full(len(n), MOST), n_positives, True)
        return every, [a.row, a.id, a.row, a.id, np.zeros(len(n), np.int64)]

    def for_negatives(opening: pa.Table):
        batch = opening.to_batches()[0]
        a, listed = Rows(batch), batch.column("positives")
        owner = np.repeat(np.arange(len(a.row)), listed.value_lengths().to_numpy(zero_copy_only=False))
        row, ids, score = (c.fill_null(NO_ID).to_numpy(zero_copy_only=False) for c in listed.flatten().flatten())
        hundreds, rest = np.divmod(score, 100)  # percents that no product overflows
        search = Search(a, owner, low * hundreds - (-low * rest // 100), high * hundreds + high * rest // 100, n_negatives, False)
        return search, [a.row[owner], a.id[owner], row, ids, score]
    positives = stored(spark, _first(_against_all(table, anchors, blocks, _searched(for_positives)), n_positives, "anchor_row")
                       .groupBy("anchor_row").agg(F.collect_list(F.struct("row", "vec_id", "score")).alias("positives")), "positives")
    with_positives = anchors.join(positives, anchors["row"] == positives["anchor_row"]).drop("anchor_row")
    found = _first(_against_all(table, with_positives, blocks, _searched(for_negatives)), n_negatives, "anchor_row", "positive_row")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                        "positive_score", F.col("score").alias("negative_score"))
