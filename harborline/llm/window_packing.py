"""Packing by order-preserving dynamic programming.

The documents' tokens, in order of doc_id, are one stream, cut into windows of at
most ``window`` tokens.  A cut may lie after a document, after a sentence and, inside a
sentence that is longer than a window by itself, at every ``GRAIN``-th of its tokens, at
a higher price.  The cuts minimise the sum, over all windows, of padding (window -
tokens) plus the penalty of truncating a document after or inside a sentence:

    cost(j) = min over i with b[j] - b[i] <= window of cost(i) + b[i]  +  window - b[j] + penalty(j)

The minimum runs over a sliding range of places, so a queue kept monotone in
cost(i) + b[i] gives each transition in constant time.

The stream is range-partitioned by (doc_id, position), so equal ids spread over
tasks too.  A task works on blocks of about ``BLOCK`` tokens and carries a
block's last, unfinished window into the next, so its memory has a bound; only a
task's last window is cut short.

Result: one row per piece: doc_id, start (tokens of its document before it),
length, doc_tokens, sequence_id, offset (place in the window), ids (the tokens,
little-endian unsigned 32-bit, as they go to a training file).

A document's tokens are the tokenizer's, no special tokens added, then
``end_id``, however long its runs of blanks or of one character are.  Texts that hold one of the tokenizer's added tokens (``added``: text to
id) get its id; without ``added`` such a text is plain text.  A null text is empty (only ``end_id``).  Null ids come first.  Rows
that repeat an id are separate documents of that id.  An empty table gives
an empty result.
"""

from __future__ import annotations

import base64
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import id_and_text
from .whole_token_counts import Pieces

BLOCK = 1 << 18          # tokens
GRAIN = 16               # tokens between places inside an overlong sentence
LONG_RUN = 20_000        # characters without or only of white space; texts that hold one are cut into pieces first
LONG_PIECE = 1000        # characters
RUN = re.compile(rf"\s{{{LONG_RUN}}}|\S{{{LONG_RUN}}}")
RANGE_BYTES = 16 << 20   # text per task
BYTE_BPE_50K_ADDED = {"<|endoftext|>": 50256}   # added tokens of byte_bpe_50k.json, which its rank file lacks
END = np.isin(np.arange(256), list(b".!?"))
ELLIPSIS = b"\xe2\x80\xa6"
BLANK = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "))


class Tokens:
    """Token ids of a byte-level BPE vocabulary, given as ranks (the same
    vocabulary and ids as the tokenizer file of that name), and their lengths in bytes."""

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int] | None = None):
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        added = added or {}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
        self.ranks, self.encoding = ranks, encoding
        self.added, self.marks = added, re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        sizes = {i: len(word) for word, i in ranks.items()} | {i: len(word.encode()) for word, i in added.items()}
        self.lengths = np.zeros(max(sizes) + 1, np.int64)
        self.lengths[list(sizes)] = list(sizes.values())
        self.pieces = None

    def ids(self, text: str) -> list[int]:
        if len(text) >= LONG_RUN and RUN.search(text):
            parts = self.marks.split(text) if self.added else [text]
            return [i for k, part in enumerate(parts) for i in ([self.added[part]] if k % 2 else self._by_piece(part))]
        if any(x in text for x in self.added):
            return self.encoding.encode(text, allowed_special="all")
        return self.encoding.encode_ordinary(text)

    def _by_piece(self, text: str) -> list[int]:
        """The ids of a text with runs too long for the encoder's own pattern and merges:
        it is cut into pieces first, and long ones are merged by ``merge``."""
        if self.pieces is None:
            self.pieces = Pieces()
        out: list[int] = []
        for piece in self.pieces(text):
            out += self.encoding.encode_ordinary(piece) if len(piece) < LONG_PIECE else merge(piece.encode(), self.ranks)
        return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: neighbours of lowest rank are merged first, the leftmost of equal
    ones, from a heap, so a piece of n bytes takes about n log n steps."""
    n = len(piece)
    part: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [rank << 40 | i for i in range(n - 1) if (rank := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = divmod(heapq.heappop(heap), 1 << 40)
        j = after[i]
        if part[i] is None or j >= n or ranks.get(part[i] + part[j]) != rank:
            continue  # an older neighbour's entry
        part[i], part[j] = part[i] + part[j], None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (right := ranks.get(part[i] + part[k])) is not None:
                heapq.heappush(heap, right << 40 | i)
        h = before[i]
        if h >= 0 and (left := ranks.get(part[h] + part[i])) is not None:
            heapq.heappush(heap, left << 40 | h)
    return [ranks[p] for p in part if p is not None]


def cuts(ends: np.ndarray, penalty: np.ndarray, window: int) -> list[int]:
    """Indices of the chosen places.  ``ends``: increasing places with gaps of at most
    ``window``; ``penalty``: the price of a cut there."""
    b, price = [0, *ends.tolist()], [0.0, *penalty.tolist()]
    n = len(b)
    key, came = [0.0] * n, [0] * n  # key: cost + place
    queue, head = [0], 0
    for j in range(1, n):
        low = b[j] - window
        while b[queue[head]] < low:
            head += 1
        i = queue[head]
        came[j] = i
        key[j] = k = key[i] + window + price[j]  # the place cancels out
        while len(queue) > head and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j > 0:
        out.append(j - 1)
        j = came[j]
    return out[::-1]


def stops(n: int, marks: np.ndarray, prices: tuple[float, float], window: int) -> tuple[np.ndarray, np.ndarray]:
    """The possible cuts of a document's ``n`` tokens and their prices."""
    place, mark = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    mark[marks] = True
    place[n] = True
    borders = np.concatenate([[0], marks, [n]])
    for k in np.flatnonzero(np.diff(borders) > window):  # overlong sentences
        place[borders[k] + GRAIN:borders[k + 1]:GRAIN] = True
    at = np.flatnonzero(place | mark)
    price = np.where(mark[at], prices[0], prices[1])
    price[-1] = 0.0
    return at, price


def pack_stream(docs, tokens: Tokens, window: int, prices: tuple[float, float], end_id: int):
    """Pieces (doc number, start, ids, window number, offset, doc tokens) of an iterator of texts."""
    queue: list[tuple[int, np.ndarray, np.ndarray, int]] = []  # (document, ids, marks, first token not yet packed)
    held, n_windows = 0, 0

    def flush(final: bool):
        nonlocal queue, held, n_windows
        if not queue:
            return
        parts, base = [], 0
        for _, ids, marks, first in queue:
            at, price = stops(len(ids) - first, marks[np.searchsorted(marks, first, "right"):] - first, prices, window)
            parts.append((at + base, price))
            base += len(ids) - first
        ends_a = np.concatenate([p[0] for p in parts])
        chosen = cuts(ends_a, np.concatenate([p[1] for p in parts]), window)
        if not final:
            chosen = chosen[:-1]
        lo, q = 0, 0
        at = queue[0][3]
        for c in chosen:
            hi, offset = int(ends_a[c]), 0
            while lo < hi:
                doc, ids, _, _ = queue[q]
                take = min(hi - lo, len(ids) - at)
                yield doc, at, ids[at:at + take], n_windows, offset, len(ids)
                lo, at, offset = lo + take, at + take, offset + take
                if at == len(ids):
                    q, at = q + 1, 0
            n_windows += 1
        queue = queue[q:]
        if queue and at:
            queue[0] = (*queue[0][:3], at)
        held = sum(len(ids) - first for _, ids, _, first in queue)

    for doc, text in docs:
        ids, marks = sentence_tokens(text, tokens, end_id)
        queue.append((doc, ids, marks, 0))
        held += len(ids)
        if held >= BLOCK:
            yield from flush(False)
    yield from flush(True)


def sentence_ends(data: np.ndarray) -> np.ndarray:
    """Byte places of the blanks that follow a sentence's end and of the line
    breaks between two texts, where more text follows at once."""
    at = np.flatnonzero((data[1:-1] == 32) | (data[1:-1] == 10)) + 1
    before, after = data[at - 1], data[at + 1]
    ellipsis = before == ELLIPSIS[2]
    ellipsis &= (data[at - 2] == ELLIPSIS[1]) & (data[at - 3] == ELLIPSIS[0]) if len(data) > 2 else False
    return at[~BLANK[after] & np.where(data[at] == 10, ~BLANK[before], END[before] | ellipsis)]


def sentence_tokens(text: str, tokens: Tokens, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(the document's ids with the end id, token counts after each sentence but
    the last).  A sentence's end inside a token is none."""
    ids = np.array([*tokens.ids(text), end_id], np.uint32)
    at = sentence_ends(np.frombuffer(text.encode(), np.uint8))
    if not len(at):
        return ids, at
    ends = np.cumsum(tokens.lengths[ids[:-1]])
    token = np.searchsorted(ends, at)
    return ids, token[ends[token] == at] + 1


def pack(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
         text_col: str = "text", window: int = 1024, prices: tuple[float, float] = (4.0, 12.0), end_id: int = 0,
         added: dict[str, int] | None = None) -> DataFrame:
    """Pack all documents; see the module text."""
    d = id_and_text(docs, id_col, text_col)
    ids = dict(d.dtypes)["doc_id"]
    size = d.agg(F.sum(F.octet_length("text") + 1).alias("b")).first().b or 0
    ordered = (d.withColumn("pos", F.monotonically_increasing_id())
               .repartitionByRange(max(1, -(-size // RANGE_BYTES)), "doc_id", "pos")
               .sortWithinPartitions("doc_id", "pos"))

    def run(batches):
        from pyspark import TaskContext
        tokens = Tokens(ranks_path, pattern, added)
        first = TaskContext.get().partitionId() << 33
        names: list = []

        def texts():
            for b in batches:
                for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    names.append(i)
                    yield len(names) - 1, t

        rows: list[tuple] = []

        def batch():
            doc, start, piece, seq, offset, total = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in doc]).cast(id_type), pa.array(start, pa.int64()),
                 pa.array([len(p) for p in piece], pa.int64()), pa.array(total, pa.int64()),
                 pa.array([first + s for s in seq], pa.int64()), pa.array(offset, pa.int64()),
                 pa.array([p.astype("<u4").tobytes() for p in piece], pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for row in pack_stream(texts(), tokens, window, prices, end_id):
            rows.append(row)
            if len(rows) >= 1000:
                yield batch()
                rows.clear()
        if rows:
            yield batch()

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(d.schema["doc_id"].dataType)
    return ordered.select("doc_id", "text").mapInArrow(
        run, f"doc_id {ids}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
