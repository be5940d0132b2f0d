"""Quality classifier: a byte-level convolutional network in numpy.

Every text is cut into chunks of ``CHUNK`` bytes that overlap by the filter
width less one, so that each filter sees each run of bytes once and the whole
document is covered.  A learned embedding of bytes goes through learned filters
of ``WIDTH`` bytes (folded into one table per filter tap, so that a chunk is a few
table look-ups), ReLU and the chunk's maximum.  The chunks' maxima are combined
into the document's mean and maximum per filter, and a logistic layer over
them gives one probability.

Training (Adam, binary cross-entropy with both labels weighted alike up to
``NEGATIVE``) runs in numpy on the driver over a bounded sample of the labelled
rows that ``trainable`` admits: at most ``SAMPLE`` documents, the ones of smallest
hash, with all their chunks.  Scoring covers every chunk of every document, in tasks.
Chunks are worked on ``BLOCK`` at a time, so memory is a few numbers a chunk.

A score is a function of the text alone.  Null and empty texts score as one chunk
of padding.  Repeated rows score alike; a label row that is null or repeated
counts once at most.  Without any usable label every score is 0.5.  An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_text as bt
from .tables import id_and_text

CHUNK, WIDTH, FILTERS, EMBEDDING = 512, 6, 16, 8
SAMPLE, BLOCK = 3000, 64
EPOCHS, BATCH, RATE = 6, 32, 0.01
SCORE_BYTES = 1 << 18
BYTES = 257  # byte values and padding
SYMBOLS = 256


def places(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, document) of every chunk."""
    step = CHUNK - WIDTH + 1
    sizes = np.diff(off)
    n = np.maximum(1, -(-np.maximum(sizes - WIDTH + 1, 1) // step))
    doc = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return off[:-1][doc] + nth * step, doc


def chunks_at(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows of CHUNK symbols, padded where their text ends."""
    at = start[:, None] + np.arange(CHUNK)
    inside = at < end[:, None]
    at[~inside] = 0
    symbols = data[at].astype(np.int16) if len(data) else np.int16(0)
    return np.where(inside, symbols, np.int16(SYMBOLS))


def chunked(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunks, document of each chunk)."""
    start, doc = places(off)
    blocks = [chunks_at(data, start[i:i + BLOCK], off[1:][doc[i:i + BLOCK]]) for i in range(0, len(doc), BLOCK)]
    return np.concatenate(blocks) if blocks else np.zeros((0, CHUNK), np.int16), doc


def init(seed: int = 5) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    return {"embedding": g.normal(0, 0.5, (BYTES, EMBEDDING)).astype(np.float32),
            "filters": g.normal(0, 0.25, (WIDTH, EMBEDDING, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": g.normal(0, 0.1, 2 * FILTERS).astype(np.float32), "out_bias": np.zeros(1, np.float32)}


def taps(w: dict) -> np.ndarray:
    """(WIDTH, BYTES, FILTERS): what each byte adds to each filter at each place."""
    return np.einsum("be,wef->wbf", w["embedding"], w["filters"]).astype(np.float32)


def _responses(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    m = x.shape[1] - WIDTH + 1
    acc = table[0][x[:, :m]]
    for k in range(1, WIDTH):
        acc += table[k][x[:, k:k + m]]
    return acc


def _combine(pooled: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Mean and maximum of the chunks' features for each document."""
    first = np.searchsorted(doc, np.arange(n))
    count = np.bincount(doc, minlength=n)[:, None]
    return np.concatenate([np.add.reduceat(pooled, first, axis=0) / count, np.maximum.reduceat(pooled, first, axis=0)],
                          axis=1)


def predict(w: dict, table: np.ndarray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    start, doc = places(off)
    pooled = np.concatenate([
        np.maximum(_responses(chunks_at(data, start[i:i + BLOCK], off[1:][doc[i:i + BLOCK]]), table).max(axis=1) + w["bias"], 0)
        for i in range(0, len(doc), BLOCK)])
    z = _combine(pooled, doc, len(off) - 1) @ w["out"] + w["out_bias"][0]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64)))


def train(texts: list[bytes], labels: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Fit the network; gradients go through each filter's largest response only."""
    w = init(seed)
    g = np.random.default_rng(seed)
    docs = []
    for t in texts:
        docs.append(chunked(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0])
    ones = max(1, int(labels.sum()))
    zeros = max(1, len(labels) - ones)
    weight = np.where(labels == 1, len(labels) / (2 * ones), len(labels) / (2 * zeros)).astype(np.float32)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    t = 0
    for _ in range(EPOCHS):
        order = g.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            x = np.concatenate([docs[i] for i in pick])
            doc = np.repeat(np.arange(len(pick)), [len(docs[i]) for i in pick])
            table, best, raw = taps(w), [], []
            for i in range(0, len(x), BLOCK):
                r = _responses(x[i:i + BLOCK], table)
                best.append(r.argmax(axis=1))
                raw.append(np.take_along_axis(r, best[-1][:, None, :], axis=1)[:, 0] + w["bias"])
            best, raw = np.concatenate(best), np.concatenate(raw)
            pooled = np.maximum(raw, 0)
            features = _combine(pooled, doc, len(pick))
            p = 1 / (1 + np.exp(-np.clip(features @ w["out"] + w["out_bias"][0], -30, 30)))
            dz = ((p - labels[pick]) * weight[pick] / len(pick)).astype(np.float32)
            grad = {"out": features.T @ dz, "out_bias": dz.sum(keepdims=True)}
            df = dz[:, None] * w["out"]
            top = features[:, FILTERS:][doc]
            ties = (pooled == top)
            shared = np.add.reduceat(ties, np.searchsorted(doc, np.arange(len(pick))), axis=0)[doc]
            counts = np.bincount(doc)[doc][:, None]
            dp = (df[doc, :FILTERS] / counts + df[doc, FILTERS:] * ties / np.maximum(shared, 1)) * (raw > 0)
            grad["bias"] = dp.sum(axis=0)
            grad["filters"], grad["embedding"] = np.zeros_like(w["filters"]), np.zeros_like(w["embedding"])
            rows = np.arange(len(x))[:, None]
            for k in range(WIDTH):
                symbol = x[rows, best + k]  # (chunks, filters)
                grad["filters"][k] = np.einsum("cfe,cf->ef", w["embedding"][symbol], dp)
                np.add.at(grad["embedding"], symbol.ravel(),
                          (dp[:, :, None] * w["filters"][k].T[None]).reshape(-1, EMBEDDING))
            t += 1
            for key, v in grad.items():
                m, s = moment[key]
                m += 0.1 * (v - m)
                s += 0.001 * (v * v - s)
                w[key] -= (RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return w


def training_rows(docs: DataFrame, labels: DataFrame, trainable: Column, id_col: str, text_col: str,
                  label_col: str, sample: int) -> tuple[list[bytes], np.ndarray]:
    """At most ``sample`` labelled texts, as many of either label as there are of the rarer up to half."""
    known = (labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(trainable).dropDuplicates(["doc_id"]))
    chosen = None
    for label in (0, 1):
        some = known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2)
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = (id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "label", "text").dropDuplicates(["doc_id"]).collect())
    rows.sort(key=lambda r: r.doc_id)
    return [r.text.encode() for r in rows], np.array([r.label for r in rows], np.int64)


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, trainable: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score, predicted) of every row; ``trainable`` is a condition on the label table's doc_id."""
    texts, y = training_rows(docs, labels, trainable, id_col, text_col, label_col, sample)
    w = train(texts, y) if len(y) else None
    table = taps(w) if w else None

    def run(batches):
        for b in batches:
            data, offsets = bt.flat(b.column("text"))
            parts = [predict(w, table, part, off) if w else np.full(j - i, 0.5)
                     for i, j, part, off in bt.slices(data, offsets, SCORE_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.concatenate(parts) if parts else [], pa.float64())], ["doc_id", "score"])

    d = id_and_text(docs, id_col, text_col)
    return (d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, score double")
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))
