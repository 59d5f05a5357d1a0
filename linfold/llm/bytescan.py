"""Numpy over the bytes of Arrow text columns: spans, words and their digests.

Everything works on segments: consecutive whole rows of a batch, together at
most ``SEGMENT`` bytes unless a single row is longer. Memory is a fixed factor
of that.

Digests are 64-bit polynomials over random byte values, read off prefix sums,
so any span's digest takes constant time, and are then mixed. Two different
spans share one with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to ``n``."""
    if len(_powers[0]) <= n:
        size = max(n + 1, SEGMENT + 1)
        for k, b in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit digests; in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Digests:
    """Digests of spans of ``values`` (bytes, or 64-bit digests of words)."""

    def __init__(self, values: np.ndarray):
        if values.dtype == np.uint8:
            values = _VALUES[values]
        n = len(values)
        self.inverse = _upto(n)[1]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _upto(n)[0][:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def sliding(self, width: int) -> np.ndarray:
        """Of every span of ``width`` values."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


def segments(batch: pa.RecordBatch, column: str = "text", limit: int = SEGMENT) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them) of each segment of a batch."""
    text = batch.column(column).cast(pa.large_string()).fill_null("")
    if len(text) == 0:
        return
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(text):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all spans, one after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, offsets of each row's first word) of the runs of
    characters other than space and \\t to \\r; words end with their row."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = offsets[:-1][offsets[:-1] < n]
    first[cut] = solid[cut]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cut = cut[cut > 0] - 1
    last[cut] = solid[cut]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span:width - span + n])


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def whole_groups(batches, names: list[str], key: str) -> Iterator[dict[str, np.ndarray]]:
    """The columns of batches sorted by ``key``, never ending inside a group."""
    kept: dict[str, list[np.ndarray]] = {c: [] for c in names}
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        last = int(np.searchsorted(cols[key], cols[key][-1]))
        if last:
            yield {c: np.concatenate([*kept[c], cols[c][:last]]) for c in names}
            kept = {c: [cols[c][last:]] for c in names}
        else:  # one group so far, or more of the last one
            if kept[key] and kept[key][-1][-1] != cols[key][0]:
                yield {c: np.concatenate(kept[c]) for c in names}
                kept = {c: [] for c in names}
            for c in names:
                kept[c].append(cols[c])
    if kept[key]:
        yield {c: np.concatenate(kept[c]) for c in names}
