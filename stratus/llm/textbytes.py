"""Vectorised hashing of words and byte n-grams over Arrow string columns (numpy inside Spark tasks).

A column's UTF-8 bytes are taken as one array, in chunks that end at document ends. A polynomial prefix
sum modulo 2**64 gives the hash of any byte span in constant time, so words, shingles and character
n-grams cost a few array passes and no Python string is made. Texts are processed whole: a chunk grows
to hold its longest document. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18  # its words, hashes and signatures take some hundred times as much in memory
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ASCII_LETTER = np.zeros(256, dtype=bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
ASCII_PUNCT = np.zeros(256, dtype=bool)
ASCII_PUNCT[33:127] = True
ASCII_PUNCT[48:58] = False
ASCII_PUNCT &= ~ASCII_LETTER

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class _Powers:
    """Powers of the base and of its inverse, extended as longer chunks come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, CHUNK_BYTES + 1)
            up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, _INVERSE, dtype=np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Chunk:
    """Whole documents ``first .. first + len(offsets) - 2`` of a column; ``offsets`` point into ``data``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __post_init__(self) -> None:
        self.up, self.down = _POWERS.get(len(self.data) + 1)
        self.prefix = np.empty(len(self.data) + 1, dtype=np.uint64)
        self.prefix[0] = 0
        np.cumsum(_BYTE[self.data] * self.up[: len(self.data)], out=self.prefix[1:])

    @property
    def docs(self) -> int:
        return len(self.offsets) - 1

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each byte span (equal bytes, equal hash)."""
        return mix((self.prefix[ends] - self.prefix[starts]) * self.down[starts])

    def characters(self) -> np.ndarray:
        """Where each character starts (any byte but a continuation of UTF-8), and the end of the chunk."""
        return np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))

    def words(self, split_punct: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the white-space separated words, and for each document the index of its
        first word (one more entry than documents). ``split_punct`` also ends a word between an ASCII
        letter and ASCII punctuation."""
        n = len(self.data)
        inside = np.empty(n + 2, dtype=bool)
        inside[0] = inside[-1] = False
        np.logical_not(SPACE[self.data], out=inside[1:-1])
        starts = inside[1:-1] & ~inside[:-2]
        ends = np.zeros(n + 1, dtype=bool)
        ends[1:] = inside[1:-1] & ~inside[2:]
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        cut = edges[inside[edges] & inside[edges + 1]]  # two documents that touch
        starts[cut] = True
        ends[cut] = True
        if split_punct and n > 1:
            inner = np.flatnonzero(ASCII_LETTER[self.data[:-1]] & ASCII_PUNCT[self.data[1:]]) + 1
            starts[inner] = True
            ends[inner] = True
        at = np.flatnonzero(starts)
        return at, np.flatnonzero(ends), np.searchsorted(at, self.offsets)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every n-byte span that lies inside one document, with its document."""
        doc = np.repeat(np.arange(self.docs), np.maximum(np.diff(self.offsets) - n + 1, 0))
        if not len(doc):
            return np.empty(0, np.uint64), doc
        lens = np.maximum(np.diff(self.offsets) - n + 1, 0)
        at = np.arange(len(doc)) + np.repeat(self.offsets[:-1] - (np.cumsum(lens) - lens), lens)
        return self.spans(at, at + n), doc


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def chunks(column: pa.Array, lower: bool = False, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column's documents in order, in chunks of about ``chunk_bytes`` (at least one document)."""
    n = len(column)
    if not n:
        return
    data, offsets = _bytes_of(column)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        part = data[offsets[first]: offsets[last]]
        yield Chunk(first, LOWER[part] if lower else part, offsets[first: last + 1] - offsets[first])
        first = last


def sums_by_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for each i (0 for an empty span), in double precision."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, dtype=np.float64, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
