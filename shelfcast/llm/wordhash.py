"""Vectorised word hashing of Arrow text batches (numpy, inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
SEGMENT = 1 << 18  # bytes hashed at once (bounds the temporary arrays)
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift rounds)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)

    def series(b: int) -> np.ndarray:
        steps = np.full(n, b, dtype=U)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return series(BASE), series(inverse)


def text_bytes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the row bounds; null is empty; ``lower`` folds A-Z only."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    if lower:
        data = data + (((data >= 65) & (data <= 90)).view(np.uint8) << 5)
    return data, offsets - offsets[0]


def byte_slices(batch: pa.RecordBatch, size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in row ranges of about ``size`` text bytes (a longer row is a range of its own)."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + size, side="right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def word_spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every white-space separated word, and the word bounds of each row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(rows), np.int64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins, ends = rows[:-1][rows[:-1] < rows[1:]], rows[1:][rows[:-1] < rows[1:]] - 1
    first[begins] = inside[begins]
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, rows)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, by prefix sums of a polynomial modulo 2**64."""
    out = np.empty(len(starts), dtype=U)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SEGMENT, side="right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        up, down = _powers(max(SEGMENT, hi - lo))
        sums = np.zeros(hi - lo + 1, dtype=U)
        np.cumsum((data[lo:hi].astype(U) + U(1)) * up[:hi - lo], out=sums[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U))
        a = b
    return out


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the batch, and each row's bounds in them."""
    data, rows = text_bytes(texts, lower)
    starts, ends, bounds = word_spans(data, rows)
    return span_hashes(data, starts, ends), bounds


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows in order, and each row's bounds; a shorter row is one window."""
    counts = np.diff(bounds)
    windows = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(windows)]).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), windows)
    at = np.arange(out[-1]) - out[row] + bounds[row] if len(row) else np.zeros(0, np.int64)
    end = bounds[1:][row]
    h = np.zeros(len(at), dtype=U)
    for j in range(k):
        use = at + j < end
        word = words[np.minimum(at + j, max(len(words) - 1, 0))] if len(at) else h
        h = np.where(use, mix(h * U(0x100000001B3) + word + U(j)), h)
    return h, out
