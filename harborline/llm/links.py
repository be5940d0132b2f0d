"""Links between members of shared lists, and their connected components.

Both work on ids only and keep every step distributed: lists, links and
components are tables in the shared folder, and the driver reads nothing but
"is it empty".
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import stored

SMALL = 16     # lists up to this size are compared pair by pair
CENTERS = 4    # members of a longer list that all others are compared with, per round
ROUNDS = 1
BLOCK = 512    # members on either side of one block of a list's last comparison
WEIGHT = 1 << 20   # and elements of their sets
COLUMNS = 4096     # elements compared at a time


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node
    reachable.  Each round hooks every node to its smallest neighbour, follows
    the hooks to their roots by pointer jumping, and contracts the edges."""
    edges = stored(spark, edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .filter("a < b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stored(spark, both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                       .select("node", F.least("node", "m").alias("up")), "hooks")
        while True:
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("root"))
            jumped = stored(spark, hooks.join(above, "up")
                            .select("node", F.col("root").alias("up"), (F.col("root") != F.col("up")).alias("moved")),
                            "hooks")
            hooks = jumped.select("node", "up")
            if jumped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = hooks.select("node", F.col("up").alias("component"))
        else:
            to = hooks.select(F.col("node").alias("component"), "up")
            labels = stored(spark, labels.join(to, "component", "left")
                            .select("node", F.coalesce("up", "component").alias("component")), "labels")
        ends = hooks.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        other = hooks.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        edges = stored(spark, edges.join(ends, "a").join(other, "b")
                       .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
                       .filter("a < b").distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _spread(lists: DataFrame) -> DataFrame:
    """The lists (key, n) whose members lie in more than one component."""
    return (lists.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.count(F.lit(1)).alias("n")).filter("lo < hi").select("key", "n"))


def list_links(spark: SparkSession, members: DataFrame, verify: Callable[[DataFrame], DataFrame],
               payload: DataFrame, near: Callable[[str, str], Column], order: str = "id",
               n_centers: int = CENTERS, last: Callable[[DataFrame], DataFrame] | None = None,
               near_first: bool = False, counted: bool = False) -> DataFrame:
    """Verified links (a, b) that connect whatever members of a common list are
    connected by links.

    ``members``: (key, id), each pair once.  ``verify`` keeps the linked rows of
    pairs (a, b).  ``payload``: one row per id; ``near(left, right)`` is a cheap
    condition on its columns that every linked pair meets.  ``order``: a column
    of ``payload``; the members smallest in it make the best centres.
    ``last``: links (a, b) between the members (key, id, component) that are
    still apart at the end, in place of the join in blocks described below.
    ``near_first``: pairs of short lists must meet ``near`` before ``verify``.
    ``counted``: ``members`` holds only the lists of several members already, with
    their lengths as ``n``.

    Short lists are compared in full.  In a long one, all members are compared
    with a few centres, a number of pairs linear in the list; members that land
    in one component need no further comparison.  What is still apart after that
    is compared across components, in blocks of bounded size; a pair that shares
    several lists counts in one of them, and only pairs that meet ``near`` leave
    the join.  So a group of thousands of near copies costs no square of pairs,
    and no link between components is lost.
    """
    if not counted:
        lists = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        members = members.join(lists, "key")
    shared = stored(spark, members, "lists")
    short = shared.filter(F.col("n") <= SMALL).select("key", "id")
    carried = [c for c in payload.columns if c != "id"] if near_first else []
    short = short.join(payload, "id") if near_first else short
    x, y = (short.select("key", F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in carried]) for s in "ab")
    met = (F.col("a") < F.col("b")) & near("a_", "b_") if near_first else F.col("a") < F.col("b")
    pairs = x.join(y, "key").filter(met).select("a", "b").distinct()
    links = stored(spark, verify(pairs), "links")
    long_ = shared.filter(F.col("n") > SMALL).select("key", "id")
    if long_.isEmpty():
        return links

    apart = stored(spark, long_.withColumn("component", F.col("id")), "long")
    for r in range(ROUNDS + 1):
        parts = components(spark, links).select(F.col("node").alias("id"), F.col("component").alias("c"))
        apart = apart.join(parts, "id", "left").select("key", "id", F.coalesce("c", "id").alias("component"))
        apart = stored(spark, apart.join(_spread(apart), "key"), "long")
        if apart.isEmpty():
            return links
        if r < ROUNDS:
            salt = F.pmod(F.xxhash64("id", F.lit(r)), F.lit(n_centers))
            first = payload.select("id", F.col(order).alias("first"))
            centers = (apart.join(first, "id").groupBy("key", salt.alias("salt"))
                       .agg(F.min(F.struct("first", "id"))["id"].alias("center"))
                       .join(apart.select("key", F.col("id").alias("center"), F.col("component").alias("own")),
                             ["key", "center"]).select("key", "center", "own"))
            met = apart.join(centers, "key").filter("component != own")
            links = stored(spark, links.unionByName(verify(_pairs(met, "id", "center"))).distinct(), "links")

    if last is not None:
        return stored(spark, links.unionByName(last(apart.drop("n"))).distinct(), "links")
    payload = payload.join(apart.groupBy("id").agg(F.collect_set("key").alias("keys")), "id")
    g = F.ceil(F.col("n") / BLOCK).cast("int")
    other = [c for c in payload.columns if c != "id"]
    # either side of the join reads the same rows, so they are shuffled once
    sides = (apart.select("key", "id", "component", g.alias("g"))
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("g")).cast("int")).join(payload, "id")
             .withColumn("to", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
             .select("key", F.least("block", "to").alias("i"), F.greatest("block", "to").alias("j"), "block", "id", "component", *other))
    left, right = (sides.select("key", "i", "j", F.col("block").alias(f"block{s}"), F.col("id").alias(s),
                                F.col("component").alias(f"c{s}"), *[F.col(c).alias(f"{s}_{c}") for c in other]) for s in "ab")
    met = (left.join(right, ["key", "i", "j"])
           .filter((F.col("ca") != F.col("cb")) & ((F.col("blocka") < F.col("blockb"))
                                                   | (F.col("i") == F.col("j")) & (F.col("a") < F.col("b"))) & near("a_", "b_")
                   & (F.array_min(F.array_intersect("a_keys", "b_keys")) == F.col("key"))))
    return stored(spark, links.unionByName(verify(_pairs(met, "a", "b"))).distinct(), "links")


def _grouped(spark: SparkSession, apart: DataFrame) -> DataFrame:
    """(key, id, component) with the lists that share members merged into one,
    where that makes fewer pairs than the lists by themselves."""
    hubs = apart.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n"))
    tied = stored(spark, apart.join(hubs, "key"), "tied")
    whole = components(spark, tied.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    tied = stored(spark, tied.join(whole.select(F.col("node").alias("hub"), F.col("component").alias("cluster")), "hub"),
                  "clusters")
    # each member counts its list's n once, so the sum over a cluster is that of n * n
    # a table of its own, of known size: while small it is broadcast, and no cluster's members meet in a task
    gain = stored(spark, tied.groupBy("cluster", "id").agg(F.sum("n").alias("met"))
                  .groupBy("cluster").agg((F.pow(F.count(F.lit(1)), F.lit(2)) <= F.sum("met")).alias("merge")), "gain")
    name = F.when(F.col("merge"), F.concat(F.lit("all "), F.col("cluster").cast("string"))).otherwise(
        F.concat(F.lit("list "), F.col("key").cast("string")))
    return tied.join(gain, "cluster").select(name.alias("key"), "id", "component").distinct()


def common_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements any two of the sets share, as a square table."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    more = count > 1
    column = np.where(more, np.cumsum(more) - 1, -1)[column]
    order = np.argsort(column, kind="stable")
    order = order[np.searchsorted(column[order], 0):]
    rows, column = rows[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for c in range(0, int(more.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, (c, c + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[rows[lo:hi], column[lo:hi] - c] = 1
        common += part @ part.T
    return common.astype(np.int64)


def _block_links(percent: int):
    def run(block: pa.Table) -> pa.Table:
        ids, sets = block.column("id"), [np.asarray(x, np.int64) for x in block.column("hashes").to_numpy()]
        _, part = np.unique(np.array(block.column("component").to_pylist()), return_inverse=True)
        n = np.array([len(x) for x in sets])
        common = common_sizes(sets)
        x, y = np.nonzero(np.triu(common * 100 >= (n[:, None] + n - common) * percent, 1) & (part[:, None] != part))
        # one link between two components says as much as many
        _, first = np.unique(np.minimum(part[x], part[y]) * len(n) + np.maximum(part[x], part[y]), return_index=True)
        return pa.table({"a": ids.take(pa.array(x[first])), "b": ids.take(pa.array(y[first]))})
    return run


def set_links(spark: SparkSession, apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between sets (id, hashes) that share a list of ``apart``
    (key, id, component) but no component: ``100 * common >= percent * union``,
    found on the full sets inside tasks, in pairs of blocks of bounded size.
    Of links between the same two components in a pair of blocks one is
    returned."""
    groups = stored(spark, _grouped(spark, apart).join(sets.select("id", F.size("hashes").alias("size")), "id"), "groups")
    sizes = groups.groupBy("key").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / WEIGHT), F.lit(1)).cast("int").alias("g"))
    sides = (groups.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("g")).cast("int"))
             .withColumn("to", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
             .select("key", F.least("block", "to").alias("i"), F.greatest("block", "to").alias("j"), "id", "component"))
    kind = dict(sets.dtypes)["id"]
    found = (sides.join(sets, "id").groupBy("key", "i", "j").applyInArrow(_block_links(percent), f"a {kind}, b {kind}"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
