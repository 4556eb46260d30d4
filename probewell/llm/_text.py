"""Vectorised byte-level helpers shared by the Arrow stages of this subpackage.

All functions work on the raw UTF-8 buffer of an Arrow batch: no Python string is built per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that separate words: tab, LF, VT, FF, CR and space.
SPACES = (9, 10, 11, 12, 13, 32)
#: Text bytes handled at once, so that the work arrays stay near the processor's caches.
SLICE_BYTES = 1 << 20

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0..n-1, modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE_BYTES + 4096)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], dtype=np.uint64))[0])


class Rolling:
    """Hashes of any byte range of a buffer, from one running sum (modulo 2**64)."""

    def __init__(self, data: np.ndarray, base: int = _BASE, inverse: int = _INVERSE):
        self.inverse, self.n = inverse, len(data)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        values = mix_table(base)[data]
        values *= _power(base, len(data))
        np.cumsum(values, out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = self.sums[end] - self.sums[start]
        raw *= _power(self.inverse, self.n + 1)[start]
        return mix(raw)

    def windows(self, width: int) -> np.ndarray:
        """Hash of every range of ``width`` bytes."""
        raw = self.sums[width:] - self.sums[:-width]
        raw *= _power(self.inverse, self.n + 1)[: len(raw)]
        return mix(raw)


_tables: dict[int, np.ndarray] = {}


def mix_table(seed: int) -> np.ndarray:
    """A fixed random 64-bit value for each byte."""
    if seed not in _tables:
        _tables[seed] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & (2**63 - 1)))
    return _tables[seed]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and the n+1 offsets of its rows; null rows are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=n + 1 + column.offset)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text each; a longer row stands alone."""
    _, offsets = buffers(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of every row: byte ranges, lower-cased hash, and the first word of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True, hashed: bool = True):
        word = _IS_WORD[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        inside = offsets[:-1][(offsets[:-1] < len(data)) & (offsets[:-1] < offsets[1:])]
        first[inside] = word[inside]
        last = word.copy()
        last[:-1] &= ~word[1:]
        tails = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        last[tails] = word[tails]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row_first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.row_first)
        if hashed:
            self.rolling = Rolling(_LOWER[data] if lower else data)
            self.hash = self.rolling.ranges(self.start, self.end)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


_STEP = [mix_int(1000 + i) | 1 for i in range(16)]


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` words, and the offsets of each row's runs.

    A row with fewer words has one run of all of them, a row without words none. Repeats stay.
    """
    h, count = words.hash, words.count
    n = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    offsets = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(n)), n)
    at = words.row_first[:-1][row] + (np.arange(offsets[-1]) - offsets[:-1][row])
    out = np.zeros(len(at), dtype=np.uint64)
    size = np.minimum(count[row], width)
    padded = np.concatenate([h, np.zeros(width, dtype=np.uint64)])
    for j in range(width):
        part = padded[at + j] * np.uint64(_STEP[j])
        part[size <= j] = np.uint64(_STEP[j + 8])
        out += part ^ (part >> np.uint64(29))
    return mix(out), offsets


def concat_ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for count[0] values, then the same for the next range."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return np.arange(total) + np.repeat(start - (ends - count), count)
