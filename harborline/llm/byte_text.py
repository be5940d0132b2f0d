"""Words, lines and their hashes over the UTF-8 bytes of an Arrow text column.

numpy over whole batches; white space is the bytes 0x09-0x0D and 0x20, which
never occur inside another character, so splitting bytes is exact.  Arrays of
several bytes a byte are made for ``SLICE_BYTES`` at a time, also inside a longer text,
and tables for more than that (one word or line of that length) are not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # documents worked on together; a longer one is on its own
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # grown as needed


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64))  # a number for each byte


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if n <= len(_POWERS[0]):
        return _POWERS[0][:n], _POWERS[1][:n]
    size, tables = max(n, min(2 * n, SLICE_BYTES + 1)), []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        np.cumprod(p, out=p)
        tables.append(p)
    if size <= SLICE_BYTES + 1:
        _POWERS[:] = tables
    return tables[0][:n], tables[1][:n]


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, bytes, offsets) of runs of whole documents of about ``limit`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def _bounds(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``, broken at document borders."""
    n = len(inside)
    first, last = np.ones(n, bool), np.ones(n, bool)
    first[1:] = ~inside[:-1]
    last[:-1] = ~inside[1:]
    first[off[:-1][off[:-1] < n]] = True
    last[off[1:][off[1:] > 0] - 1] = True
    return np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1


def owner(off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The document that each byte position lies in."""
    return np.searchsorted(off, at, "right") - 1


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word."""
    starts, ends = _bounds(~SPACE[data], off)
    return starts, ends, owner(off, starts)


def lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every line that is not empty."""
    starts, ends = _bounds(data != 0x0A, off)
    return starts, ends, owner(off, starts)


def span_hashes(data: np.ndarray, *spans: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """64-bit hashes of the spans' bytes, the same wherever a span lies.  The starts
    and the ends of a list of spans ascend."""
    return [_span_hashes(data, starts, ends) for starts, ends in spans]


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + SLICE_BYTES, "right")))
        hi = int(ends[j - 1])
        power, inverse = _powers(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_CODES[data[lo:hi]] * power[:hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * inverse[s])
        i = j
    return out


def sequence_hashes(values: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs ``values[first:after]``."""
    power, inverse = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values) * power[:len(values)], out=sums[1:])
    return mix((sums[after] - sums[first]) * inverse[first])


def counted(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many flagged bytes each document has."""
    if len(flags) > SLICE_BYTES:  # one document, as a rule
        return np.array([np.count_nonzero(flags[i:j]) for i, j in zip(off[:-1], off[1:])], np.int64)
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[off[1:]] - sums[off[:-1]]


def before(flagged: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the ascending places ``flagged`` lie before each of ``at``."""
    return np.searchsorted(flagged, at)


def windows(hashes: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of ``n`` words within one document, with
    its first word's index as the third item."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    acc = np.zeros(m, np.uint64)
    for k in range(n):
        acc = acc * np.uint64(_BASE) + hashes[k:k + m]
    at = np.flatnonzero(owners[:m] == owners[n - 1:])
    return mix(acc[at]), owners[at], at
