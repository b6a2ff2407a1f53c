"""Numpy helpers that Arrow tasks share: chunks of documents as one byte
buffer, words, polynomial hashes of byte ranges, sliding minima.

All work is done on bounded chunks (about ``CHUNK_BYTES`` of text; one longer
document makes a chunk of its own), so a task's memory does not depend on the
number of rows it reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 3 << 19
U64 = np.uint64
BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xD1B54A32D192ED03

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` bytes of ``column`` (one row at least)."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def joined(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a line feed after each document, and the documents' starts (one more than documents)."""
    buf = np.frombuffer(b"\n".join(docs) + b"\n", dtype=np.uint8)
    sizes = np.fromiter((len(d) + 1 for d in docs), dtype=np.int64, count=len(docs))
    return buf, np.concatenate([[0], np.cumsum(sizes)])


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of a buffer that ends in a separator."""
    inside = ~_IS_SPACE[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(buf) and inside[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Poly:
    """Polynomial hashes (mod 2**64) of byte ranges of one buffer; content only, wherever the range lies."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, buf: np.ndarray, base: int = BASE_A):
        power, self.inverse = self._table(base, len(buf) + 1)
        self.prefix = np.zeros(len(buf) + 1, dtype=U64)
        terms = self.prefix[1:]  # summed where they are
        terms[:] = buf
        terms += U64(1)
        terms *= power[: len(buf)]
        np.cumsum(terms, out=terms)

    @classmethod
    def _table(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(base)
        if have is None or len(have[0]) < n:
            n = -(-n >> 17) << 17  # grows by steps: as long as the chunks in use, not as the longest possible one
            have = tuple(np.full(n, b, dtype=U64) for b in (base, pow(base, -1, 1 << 64)))
            for powers in have:
                powers[0] = 1
                np.cumprod(powers, out=powers)
            if n < 4 * CHUNK_BYTES:  # a very long document's table is not kept
                cls._powers[base] = have
        return have

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(Poly(buf).ranges(start, end))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words (order matters); may cross documents."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    h = np.full(n, size, dtype=U64)
    for i in range(size):
        h = (h ^ words[i : i + n]) * U64(0x9FB21C651E98DF25)
        h ^= h >> U64(32)
    return mix(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, in three passes whatever the width."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    pad = -len(x) % width
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, dtype=x.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(full, axis=1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[0::2], edge[1::2]


def covered(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True at each position below ``size`` that some range holds."""
    depth = np.zeros(size + 1, dtype=np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:-1]) > 0


def gather_ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of the ranges' elements, one range after the other."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - first, length)
