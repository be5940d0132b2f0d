"""MinHash near-duplicates by bottom-k sketches of one hash function.

A document is the set of its distinct word shingles (ASCII lower case).  One
scan hashes each set and keeps its size, two checksums and its ``k`` smallest
hashes, the sketch.  Documents with one set are a class; classes are compared.

* Inverted lists: two linked sets share at least ``LEAST`` of either sketch (12 of
  32, all but a chance below 1e-8 at a similarity of 0.8).  So with a sketch's
  values ordered from the rarest on, a linked pair shares one of all but the last
  11 of its shared values; only these are listed.  Values of a passage that
  thousands of documents hold are listed only where most of the document is
  that passage.  A list is further split by set size.
* Estimate: the k smallest of two sketches' union are the union's own sketch;
  the share of them that both have estimates the similarity.  Pairs that share
  less than ``LEAST`` of it go, and so do pairs of too unlike sizes.
* Exact: the remaining pairs' full sets are hashed again and intersected.

Long lists go through ``links.list_links``: all members are compared with a
centre, the sketch with the fewest values of its own, that is, the least changed
copy.  What is still apart then is compared on the full sets inside tasks, in
blocks, and only links between different components leave them.

Result: one row per row: doc_id, n_shingles, component_id (smallest doc_id
reachable over links), kept.  Null, empty and blank texts have no shingle and are
linked with nothing.  Classes are told apart by their sets, not by ids: rows that
repeat an id with different texts are in their texts' components, and the row of a
null id is in its text's component, whose smallest other id names it (null if there
is none).  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import byte_text as bt
from .links import components, list_links, set_links
from .tables import id_and_text, stored

K = 32
LEAST = 0.375            # of a sketch that linked sets share
BATCH_ROWS = 1 << 20     # sketches that leave a task at a time: a whole batch
SET_ROWS = 256           # full sets that leave a task at a time
BROADCAST_IDS = 1 << 20  # ids of 8 bytes; up to so many are broadcast


def shingle_sets(column, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of an Arrow column."""
    data, offsets = bt.flat(column)
    for i, j, part, off in bt.slices(data, offsets):
        part = bt.LOWER[part]
        starts, ends, doc = bt.words(part, off)
        word, = bt.span_hashes(part, (starts, ends))
        shingle, owners, _ = bt.windows(word, doc, size)
        at = np.searchsorted(owners, np.arange(j - i + 1))
        first = np.searchsorted(doc, np.arange(j - i + 1))
        for k in range(j - i):
            own = shingle[at[k]:at[k + 1]]
            if not len(own) and first[k] < first[k + 1]:  # fewer words than a shingle: all of them are one
                few = word[first[k]:first[k + 1]]
                acc = np.uint64(len(few))
                for w in few:
                    acc = bt.mix(np.array([acc]) + w)[0]
                own = np.array([acc], np.uint64)
            yield np.unique(own)


def _names(u: np.ndarray) -> tuple[int, int, int]:
    """Size and two checksums of a set."""
    return (len(u), int(u.sum(dtype=np.uint64).view(np.int64)),
            int(bt.mix(u ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).view(np.int64)))


def _named_sets(size: int, kept: Callable[[np.ndarray], np.ndarray], column: str, rows: int):
    """Batches (other columns, n_shingles, sum1, sum2, ``column``: what is ``kept`` of a text's set)."""
    def run(batches):
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), rows):
                b = whole.slice(at, rows)
                names, lists = [], []
                for u in shingle_sets(b.column("text"), size):
                    names.append(_names(u))
                    lists.append(kept(u))
                columns = zip(*names) if names else [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-1], *[pa.array(c, pa.int64()) for c in columns], pa.array(lists, pa.list_(pa.int64()))],
                    [*b.schema.names[:-1], "n_shingles", "sum1", "sum2", column])
    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """Link documents whose shingle sets have ``100 * common >= percent * union``
    (``percent`` below 100)."""
    d = id_and_text(docs, id_col, text_col)
    ids = dict(d.dtypes)["doc_id"]
    sketched = stored(spark, d.mapInArrow(
        _named_sets(shingle, lambda u: (u[:k] >> np.uint64(1)).astype(np.int64), "sketch", BATCH_ROWS),
        f"doc_id {ids}, n_shingles long, sum1 long, sum2 long, sketch array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "sketches")
    key = ["n_shingles", "sum1", "sum2"]
    classes = stored(spark, sketched.filter("n_shingles > 0").groupBy(*key).agg(
        F.min("row").alias("id"), F.min("doc_id").alias("first")), "classes")
    sketch = stored(spark, sketched.join(classes.select(F.col("id").alias("row")), "row")
                    .select(F.col("row").alias("id"), F.col("n_shingles").alias("n"), "sketch"), "class-sketches")

    values = sketch.select("id", F.col("n").alias("size"), F.size("sketch").alias("s"), F.explode("sketch").alias("key"))
    shared = values.groupBy("key").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 1")
    # how many of a sketch's values no other sketch has
    common_values = values.join(shared, "key").groupBy("id").agg(F.count(F.lit(1)).alias("held"))
    payload = stored(spark, sketch.join(common_values, "id").withColumn("lone", F.size("sketch") - F.col("held")).drop("held"),
                     "payload")
    rank = Window.partitionBy("id").orderBy("freq", "key")
    least = F.ceil(F.col("s") * LEAST)
    lists = (values.join(shared, "key").withColumn("rank", F.row_number().over(rank))
             .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("id")))
             .filter(F.col("rank") <= F.col("n") - least + 1).select("key", "id", "size"))
    # sets whose sizes may be linked lie in one size band or in neighbouring ones
    band = F.floor(F.log("size") / math.log(100 / percent) + 1e-9)
    lists = lists.withColumn("band", F.explode(F.array(band, band + 1))).select(
        F.xxhash64("key", "band").alias("key"), "id").distinct()

    def near(a: str, b: str) -> Column:
        na, nb = F.col(f"{a}n"), F.col(f"{b}n")
        sa, sb = F.col(f"{a}sketch"), F.col(f"{b}sketch")
        union = F.slice(F.array_sort(F.array_union(sa, sb)), 1, k)
        both = F.size(F.array_intersect(F.array_intersect(sa, sb), union))
        return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (both >= F.size(union) * LEAST)

    def full_sets(wanted: DataFrame) -> DataFrame:
        """(id, hashes) of the wanted classes: the texts that bear a class's first id are
        hashed again, and those of another set of that id drop out by its name."""
        chosen = stored(spark, classes.join(wanted, "id"), "chosen")
        some = F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS else chosen
        texts = d.join(some.select("first").distinct(), F.col("doc_id").eqNullSafe(F.col("first")), "left_semi")
        sets = texts.select("text").mapInArrow(
            _named_sets(shingle, lambda u: u.view(np.int64), "hashes", SET_ROWS),
            "n_shingles long, sum1 long, sum2 long, hashes array<long>")
        return stored(spark, sets.join(some, key).select("id", "hashes").dropDuplicates(["id"]), "sets")

    def last(apart: DataFrame) -> DataFrame:
        sets = full_sets(stored(spark, apart.select("id").distinct(), "wanted"))
        return set_links(spark, apart, sets, percent)

    def verify(pairs: DataFrame) -> DataFrame:
        sides = [sketch.select(F.col("id").alias(x), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch"))
                 for x in "ab"]
        close = stored(spark, pairs.join(sides[0], "a").join(sides[1], "b").filter(near("a_", "b_")).select("a", "b"),
                       "close")
        wanted = stored(spark, close.select(F.col("a").alias("id")).unionByName(close.select(F.col("b").alias("id")))
                        .distinct(), "wanted")
        sets = full_sets(wanted)
        full = [sets.select(F.col("id").alias(x), F.col("hashes").alias(f"{x}_set")) for x in "ab"]
        common = F.size(F.array_intersect("a_set", "b_set"))
        return (close.join(full[0], "a").join(full[1], "b")
                .filter(common * 100 >= (F.size("a_set") + F.size("b_set") - common) * percent).select("a", "b"))

    links = list_links(spark, stored(spark, lists, "lists"), verify, payload, near, order="lone",
                       n_centers=1, last=last)
    groups = stored(spark, components(spark, links).select(F.col("node").alias("id"), F.col("component").alias("c"))
                    .join(classes.select("id", "first"), "id"), "groups")
    named = groups.groupBy("c").agg(F.min("first").alias("named"))
    linked = groups.join(named, "c").select("id", "named", F.lit(True).alias("linked"))
    members = sketched.drop("sketch").join(classes, key, "left").join(linked, "id", "left")
    component = (F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("linked"), F.col("named"))
                 .otherwise(F.col("first")))
    return (members.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
