"""Texts of an Arrow batch as one byte array, its words and their hashes, with NumPy.

Hashes are polynomials modulo 2**64 over random byte values, taken from prefix sums, so the
hash of any stretch costs two lookups; a final mix spreads it over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document is a piece of its own.
TILE = 1 << 20

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_random = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the base, or of its inverse."""
    have = _powers.get(inverse)
    if have is None or len(have) < n:
        step = pow(BASE, -1, 1 << 64) if inverse else BASE
        size = max(n, TILE + 1)
        out = np.full(size, step, np.uint64)
        out[0] = 1
        have = _powers[inverse] = np.cumprod(out, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all its bits; works in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Rolling:
    """Hashes of stretches of a sequence of codes."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(codes * powers(self.n), out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * powers(self.n + 1, True)[starts])

    def windows(self, k: int) -> np.ndarray:
        """Hashes of all stretches of length ``k``, by start."""
        m = self.n - k + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:m]) * powers(m, True))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, nulls as empty, and the offsets of its rows."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if large else np.int32
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def tiles(offsets: np.ndarray, limit: int = TILE) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes together, or one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def byte_classes(separators: bytes) -> np.ndarray:
    """For each byte 0 if it separates words, else the byte with A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


class Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``: where they start and end, their
    hashes, and ``first``, the number of the first word of each text and one more."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, classes: np.ndarray):
        codes = classes[data]
        inside = codes != 0
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begin[edges] = inside[edges]
        finish[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = Rolling(BYTE_CODES[codes]).spans(self.starts, self.ends)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` hashes, by its first."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out *= np.uint64(BASE)
        out += hashes[i : i + m]
    return mix(out)


def within(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total - n + 1`` runs of ``n`` items stay within one text, given the number of
    each text's first item."""
    ok = np.ones(max(0, total - n + 1), bool)
    for back in range(1, n):
        at = first[1:-1] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


def offsets_of(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def slices(batch: pa.RecordBatch, column: int, limit: int = TILE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The rows of a batch in tiles: first and last row, bytes and offsets of the text column."""
    data, offsets = utf8(batch.column(column))
    for i, j in tiles(offsets, limit):
        low, high = offsets[i], offsets[j]
        yield i, j, data[low:high], offsets[i : j + 1] - low
