"""Text columns as numpy arrays: code points, words and rolling hashes for whole batches at once.

Every function takes whole texts. Nulls count as empty texts. Nothing here keeps
state between batches, so a result never depends on how rows are batched.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A function's arrays take about 60 times as much while it runs.
CHUNK_BYTES = 1_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it


def release() -> None:
    """Give memory that is free back to the system: workers wait for their next task with all they ever had, and many share an executor's memory."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse modulo 2**64."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((BASE, BASE_INVERSE)):
            table = np.full(n + n // 4 + 2, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(1)
def char_tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower case code point, class) of the code points below 65536; class 1 letter, 2 other alphanumeric, 3 space."""
    lower, kind = np.arange(65536, dtype=np.uint32), np.zeros(65536, np.uint8)
    for i in range(65536):
        c = chr(i)
        if c.isspace():
            kind[i] = 3
        elif c.isalnum():
            kind[i] = 1 if c.isalpha() else 2
            if len(x := c.lower()) == 1:
                lower[i] = ord(x)
    return lower, kind


def decode(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a string column, and where each row begins (one more offset than rows)."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    bounds = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = bytes(memoryview(data)[bounds[0] : bounds[-1]]) if data is not None else b""
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    bounds = bounds - bounds[0]
    if len(points) != len(raw):
        heads = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(heads)])[bounds]
    return points, bounds


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts take about ``limit`` bytes, or of one row where a text is longer."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    which = np.cumsum(sizes.astype(np.int64) + 1) // limit
    starts = np.concatenate([[0], np.flatnonzero(np.diff(which)) + 1, [batch.num_rows]])
    for a, b in zip(starts[:-1], starts[1:]):
        yield batch.slice(int(a), int(b - a))
    release()


def classify(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower case code points, classes) of code points of any size."""
    lower, kind = char_tables()
    if len(points) and points.max() >= 65536:
        low, kinds = points.copy(), np.zeros(len(points), np.uint8)
        small = points < 65536
        low[small], kinds[small] = lower[points[small]], kind[points[small]]
        for p in np.unique(points[~small]):
            c = chr(p)
            if c.isalnum():
                at = points == p
                kinds[at] = 1 if c.isalpha() else 2
                low[at] = ord(c.lower()) if len(c.lower()) == 1 else p
        return low, kinds
    return lower[points], kind[points]


@dataclass
class Words:
    """Words of a batch: runs of alphanumeric characters, in order of row and position."""

    points: np.ndarray  # code points as they are
    lower: np.ndarray
    kind: np.ndarray
    offsets: np.ndarray  # where each row begins, in code points
    start: np.ndarray  # of each word, in code points of the whole batch
    end: np.ndarray
    row: np.ndarray
    prefix: np.ndarray  # rolling sums of the lower case code points
    hash: np.ndarray  # 64 bits of each lower case word

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def bounds(self) -> np.ndarray:
        """Where each row's words begin, as an index into the words."""
        return np.concatenate([[0], np.cumsum(self.counts())])


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of True that don't cross the beginning of a row."""
    n = len(mask)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = np.zeros(n + 1, bool)
    fresh[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, mask[:-1]
    start = np.flatnonzero(mask & (~before | fresh[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, mask[1:]
    end = np.flatnonzero(mask & (~after | fresh[1:])) + 1
    return start, end


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the characters of each span, the same wherever the span lies."""
    inverse = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def rolling(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers of the base; one longer than values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def words(col: pa.Array) -> Words:
    points, offsets = decode(col)
    lower, kind = classify(points)
    start, end = runs((kind == 1) | (kind == 2), offsets)
    prefix = rolling(lower)
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(points, lower, kind, offsets, start, end, row, prefix, span_hash(prefix, start, end))


def grams(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of each ``k`` successive words of one row, and the index of the first of them."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * BASE + hashes[j : j + n]
    at = np.flatnonzero(row[:n] == row[k - 1 : k - 1 + n])
    return mix(total[at]), at


def segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of the given lengths laid end to end: the list of each place, and its index within the list."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
