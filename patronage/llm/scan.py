"""Vectorised reading of text columns: words and their hashes straight from Arrow's buffers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_SALT = np.array(
    [(0xD6E8FEB86659FD93 * (i + 1) ^ 0xA0761D6478BD642F) & _MASK for i in range(256)], np.uint64
)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly (the splitmix64 finaliser)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def unmix(values: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    values = values.astype(np.uint64, copy=True)
    values ^= (values >> np.uint64(31)) ^ (values >> np.uint64(62))
    values *= np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    values ^= (values >> np.uint64(27)) ^ (values >> np.uint64(54))
    values *= np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    values ^= (values >> np.uint64(30)) ^ (values >> np.uint64(60))
    return values


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to ``n``."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of some texts: ``first[i]:first[i+1]`` are those of text ``i``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = _power_tables(len(self.data) + 1)
        running = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_SALT[self.data] * up[: len(self.data)], out=running[1:])
        raw = (running[self.end] - running[self.start]) * down[self.start]
        return mix(raw ^ (self.end - self.start).astype(np.uint64) * np.uint64(_BASE))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each begins; null is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray, lower: bool = True) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, with A-Z lower-cased if asked."""
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    begins[edges] |= inside[edges]
    ends[edges - 1] |= inside[edges - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, bounds))


def blocks(batch: pa.RecordBatch, column: str | int, limit: int = 8 << 20):
    """Slices of a batch whose texts have ``limit`` bytes at most, or are single rows."""
    sizes = np.diff(text_bytes(batch.column(column))[1])
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)
