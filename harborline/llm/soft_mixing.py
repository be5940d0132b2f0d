"""Mixing documents to target domain weights by soft membership.

A multinomial logistic classifier over hashed words, trained in numpy on a
bounded sample of the labelled table (at most ``SAMPLE`` documents), gives every
document its domain posteriors.  The rates r >= 0 of the documents minimise

    1/2 sum_k w_k (A_k - target_k)^2,   A_k = sum_d r_d tokens_d p_dk / all tokens,

by projected gradient steps from r = 1, in the metric in which a document counts by
its tokens.  A step at a document is p_d . v, v = M (A - target), the same formula for
all, so a round sends the few numbers of v to the tasks, and the tasks send back their
partial sums of A and of p p' over the documents whose rate is not at 0.  M is the
inverse of the latter, so a step is exact but for documents that reach 0 in it; where
that does not bring A nearer, v is halved, and then M is the plain weight
w_k = 1 / (natural share of domain k).  A few rounds reach ``TOLERANCE``; a
document's rate is replayed from their v, and nothing per document is gathered or
rewritten.  The gap that is left is a column of the result, and one above the
tolerance (targets that no rates reach) also a warning.

The sample's texts are read whole; each leaves its task as the buckets of its words.

Result: one row per row: doc_id, tokens (words), one posterior per domain
(p_<domain>), rate, copies (rate rounded up or down by a hash of the id, so that
its expectation is the rate), gap (largest difference of a domain's share from its target).

Null and empty texts have no tokens and the posteriors of a text without words;
they do not move the totals.  Repeated rows get equal rates.  A null id is hashed
like any other.  A domain that no document belongs to keeps its shortfall.  An
empty table gives an empty result; without any label all domains are equally
likely.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_text as bt
from .tables import id_and_text, stored

BUCKETS = 1 << 16
SAMPLE = 3000
EPOCHS, RATE, DECAY = 80, 0.5, 1e-5
ROUNDS, TOLERANCE = 20, 1e-4
HALVINGS = 3
DOMAINS = ("good", "low", "toxic")


def domain_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """The domain number of a label row: toxic, else by quality."""
    return F.when(F.col(toxic) == 1, 2).when(F.col(quality) == 1, 0).when(F.col(quality) == 0, 1)


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, document, value) of each document's distinct words, and its word count."""
    n = len(off) - 1
    starts, ends, doc = bt.words(data, off)
    word, = bt.span_hashes(bt.LOWER[data], (starts, ends))
    pair = np.unique(doc * BUCKETS + (word & np.uint64(BUCKETS - 1)).astype(np.int64))
    bucket, owner = pair % BUCKETS, pair // BUCKETS
    size = np.bincount(owner, minlength=n)
    return bucket, owner, 1 / np.sqrt(np.maximum(size, 1))[owner], np.bincount(doc, minlength=n)


def posteriors(w: np.ndarray, bias: np.ndarray, bucket, owner, value, n: int) -> np.ndarray:
    z = np.stack([np.bincount(owner, w[bucket, k] * value, minlength=n) for k in range(len(bias))], axis=1) + bias
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(buckets: list[np.ndarray], y: np.ndarray, n_domains: int) -> tuple[np.ndarray, np.ndarray]:
    """Full-batch Adam on the cross-entropy, given each text's distinct buckets; unseen
    domains stay improbable."""
    w, bias = np.zeros((BUCKETS, n_domains)), np.zeros(n_domains)
    if not len(y):
        return w, bias
    size = np.array([len(b) for b in buckets])
    bucket, owner = np.concatenate(buckets).astype(np.int64), np.repeat(np.arange(len(y)), size)
    value = 1 / np.sqrt(np.maximum(size, 1))[owner]
    target = np.eye(n_domains)[y]
    m, s = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, EPOCHS + 1):
        d = (posteriors(w, bias, bucket, owner, value, len(y)) - target) / len(y)
        g = np.stack([np.bincount(bucket, d[owner, k] * value, minlength=BUCKETS) for k in range(n_domains)], axis=1)
        g += DECAY * w
        m += 0.1 * (g - m)
        s += 0.01 * (g * g - s)
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-6)
        bias -= d.sum(axis=0)
    return w, bias


def _training_rows(docs: DataFrame, labels: DataFrame, domain: Column, id_col: str, text_col: str, n: int, sample: int):
    """At most sample // n rows of each domain, those of smallest hash; and the domains' shares of all labels."""
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), domain.alias("domain")).filter(
        "doc_id IS NOT NULL AND domain IS NOT NULL").dropDuplicates(["doc_id"])
    counts = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}  # one row per domain
    chosen = None
    for k in range(n):
        some = known.filter(F.col("domain") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // n)
        chosen = some if chosen is None else chosen.unionByName(some)
    def bucketed(batches):
        for b in batches:
            data, offsets = bt.flat(b.column("text"))
            lists = []
            for i, j, part, off in bt.slices(data, offsets):
                bucket, owner, _, _ = features(part, off)
                lists += np.split(bucket.astype(np.int32), np.searchsorted(owner, np.arange(1, j - i)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("domain"), pa.array(lists, pa.list_(pa.int32()))],
                                             ["doc_id", "domain", "buckets"])

    sampled = (id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
               .select("doc_id", F.col("domain").cast("int").alias("domain"), "text").dropDuplicates(["doc_id"]))
    kind = dict(sampled.dtypes)["doc_id"]
    rows = sampled.mapInArrow(bucketed, f"doc_id {kind}, domain int, buckets array<int>").collect()  # sample x BUCKETS at most
    rows.sort(key=lambda r: r.doc_id)
    shares = np.array([counts.get(k, 0) for k in range(n)], float)
    return [np.array(r.buckets, np.int32) for r in rows], np.array([r.domain for r in rows], np.int64), shares


def _replay(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    r = np.ones(len(p))
    for v in steps:
        r = np.maximum(0.0, r - p @ v)
    return r


def fit(sums, goal: np.ndarray) -> tuple[list[np.ndarray], float]:
    """The steps v that lead from rates of 1 to the goal, and the gap that is left; ``sums``
    measures what a list of steps leads to."""
    steps: list[np.ndarray] = []
    total, share, gram = sums(steps)
    gap = float(np.abs(share - goal).max())
    if not total:
        return steps, 0.0
    weight = 1 / np.maximum(share, 1e-6)

    def price(share: np.ndarray) -> float:
        return float(weight @ (share - goal) ** 2)
    while len(steps) < ROUNDS and gap > TOLERANCE:
        exact = np.linalg.pinv(gram, rcond=1e-9, hermitian=True) @ (share - goal)
        root = np.sqrt(weight)
        length = 1 / max(np.linalg.eigvalsh(root[:, None] * gram * root[None, :]).max(), 1e-12)
        for v in [exact / 2 ** h for h in range(HALVINGS)] + [length * weight * (share - goal)]:
            _, to, its_gram = sums([*steps, v])
            if price(to) < price(share):
                break
        else:
            break  # no step leads nearer
        moved = float(np.abs(to - share).max())
        steps.append(v)
        share, gram, gap = to, its_gram, float(np.abs(to - goal).max())
        if moved < TOLERANCE / 10:
            break
    return steps, gap


def mix(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: tuple[float, ...], domain: Column | None = None,
        domains: tuple[str, ...] = DOMAINS, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Rates that bring the expected token shares of ``domains`` to ``targets`` (shares of today's tokens)."""
    n = len(domains)
    buckets, y, label_shares = _training_rows(docs, labels, domain_of() if domain is None else domain, id_col, text_col, n, sample)
    w, bias = train(buckets, y, n)
    if len(y):  # the sample holds the domains alike; back to the labels' own shares
        seen = np.maximum(np.bincount(y, minlength=n) / len(y), 1e-9)
        bias = bias + np.log(np.maximum(label_shares / label_shares.sum(), 1e-9) / seen)
    w32 = w.astype(np.float32)
    d = id_and_text(docs, id_col, text_col)
    ids = dict(d.dtypes)["doc_id"]

    def classify(batches):
        for b in batches:
            data, offsets = bt.flat(b.column("text"))
            p, t = [np.zeros((0, n))], [np.zeros(0, np.int64)]
            for i, j, part, off in bt.slices(data, offsets):
                bucket, owner, value, words = features(part, off)
                p.append(posteriors(w32, bias, bucket, owner, value, j - i))
                t.append(words)
            p = np.concatenate(p)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.concatenate(t), pa.int64()),
                                              *[pa.array(p[:, k], pa.float64()) for k in range(n)]],
                                             ["doc_id", "tokens", *[f"p_{k}" for k in domains]])

    names = [f"p_{k}" for k in domains]
    known = stored(spark, d.mapInArrow(classify, f"doc_id {ids}, tokens long, " + ", ".join(f"{c} double" for c in names)),
                   "posteriors")

    def sums(steps: list[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
        """Tokens of all documents, their shares A of the domains at these rates, and the mean of
        p p' over the tokens of documents whose rate is not 0."""
        def partial(batches):
            for b in batches:
                p = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)
                t = b.column("tokens").to_numpy(zero_copy_only=False).astype(float)
                r = _replay(p, steps)
                out = [t.sum(), *((r * t) @ p), *(p.T @ (p * (t * (r > 0))[:, None])).ravel()]
                yield pa.RecordBatch.from_arrays([pa.array([float(v)]) for v in out], [f"s{i}" for i in range(len(out))])
        width = 1 + n + n * n
        row = (known.select("tokens", *names).mapInArrow(partial, ", ".join(f"s{i} double" for i in range(width)))
               .agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]).first())
        total, *rest = (v or 0.0 for v in row)
        of_all = np.array(rest) / max(total, 1.0)
        return total, of_all[:n], of_all[n:].reshape(n, n)

    steps, gap = fit(sums, np.asarray(targets, float))
    if gap > TOLERANCE:
        warnings.warn(f"mixing: shares miss their targets by up to {gap:.2g}", stacklevel=2)

    def rates(batches):
        for b in batches:
            p = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_replay(p, steps), pa.float64())],
                                             [*b.schema.names, "rate"])

    rated = known.mapInArrow(rates, f"doc_id {ids}, tokens long, " + ", ".join(f"{c} double" for c in names) + ", rate double")
    chance = F.pmod(F.xxhash64(F.lit("copies"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    whole = F.floor("rate")
    return rated.withColumn("copies", (whole + F.when(chance < F.col("rate") - whole, 1).otherwise(0)).cast("long")).withColumn("gap", F.lit(gap))
