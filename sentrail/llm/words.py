"""Whole texts of an Arrow batch as numpy words: byte spans, 64-bit hashes, runs per document.

All functions work on whole texts; a block only limits how many texts are in memory together. Word hashes
are 64-bit and salted by fixed random tables: two different words meet with probability 2**-64, which the
callers take as equality.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"
_random = np.random.default_rng(20_240_229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_RADIX = np.uint64(0x9E3779B97F4A7C15)

#: ``[^\x20\x09-\x0D]+``: what is not white space
BY_SPACE = np.array([byte not in _SPACE for byte in range(256)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z: ASCII letters and digits, and all beyond ASCII
ALNUM = np.array([byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A for byte in range(256)])
LOWER = np.array([byte + 32 if 0x41 <= byte <= 0x5A else byte for byte in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``most`` bytes of text, or of one row where a text is longer."""
    sizes = np.diff(_offsets(batch.column(column)))
    start = 0
    while start < batch.num_rows:
        total, stop = 0, start
        while stop < batch.num_rows and (stop == start or total + sizes[stop] <= most):
            total += int(sizes[stop])
            stop += 1
        yield batch.slice(start, stop - start)
        start = stop


def _large(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())


def _offsets(column: pa.Array) -> np.ndarray:
    large = _large(column)
    return np.frombuffer(large.buffers()[1], dtype=np.int64)[large.offset : large.offset + len(large) + 1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts end to end, and where each begins (one more for the end). Null counts as empty."""
    large = _large(column)
    offsets = np.frombuffer(large.buffers()[1], dtype=np.int64)[large.offset : large.offset + len(large) + 1]
    if large.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(large) + 1, dtype=np.int64)
    data = np.frombuffer(large.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of a block of texts. ``of`` has, for each text and the end, the number of its first word."""

    data: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word, from its bytes and their places."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        if not len(out):
            return out
        lengths = self.ends - self.starts
        powers = np.cumprod(np.full(int(lengths.max()), _RADIX, dtype=np.uint64))
        ends = np.cumsum(lengths)
        low = 0
        while low < len(out):
            before = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, "right")))
            part = lengths[low:high]
            first = np.cumsum(part) - part
            place = np.arange(int(part.sum())) - np.repeat(first, part)
            byte = self.data[np.repeat(self.starts[low:high], part) + place]
            out[low:high] = np.add.reduceat(_BYTE[byte] * powers[place], first)
            low = high
        return mix(out)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text of a number for each word."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.of[1:]] - total[self.of[:-1]]


def split(column: pa.Array, table: np.ndarray, lower: bool = False) -> Words:
    data, texts = text_bytes(column)
    if lower:
        data = LOWER[data]
    inside = table[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    edges = texts[(texts > 0) & (texts < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, texts, starts, ends, np.searchsorted(starts, texts))


def windows(hashes: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside one text, and the number of its first word."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    last = len(hashes) - size + 1
    out = np.zeros(last, dtype=np.uint64)
    for k in range(size):
        out = mix(out * _RADIX + hashes[k : last + k])
    ends = np.repeat(of[1:], np.diff(of))[:last]
    first = np.flatnonzero(np.arange(last) + size <= ends)
    return out[first], first


def covered(first: np.ndarray, lengths: np.ndarray | int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in any run given by its first word and length."""
    edge = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edge, first, 1)
    np.subtract.at(edge, first + lengths, 1)
    return np.cumsum(edge[:-1]) > 0
