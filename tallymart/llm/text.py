"""Words and lines of many texts at once, as numpy arrays over their UTF-8 bytes.

Used inside Arrow tasks. A batch is cut into pieces of about ``PIECE`` bytes (a
longer text is a piece of its own), so memory follows the piece and never the
batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 2_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

#: The bytes that separate words.
_SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[_SPACES] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(n, base & _MASK, np.uint64)
            factors[0] = 1
            made.append(np.multiply.accumulate(factors))
        if n > 4 * PIECE:
            return made[0], made[1]
        _powers = made[0], made[1]
    return _powers


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``values[start:end]``, equal for equal contents."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUE[data]


def salted(hashes: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """``hashes`` made distinct by ``salt``, such as the number of the text."""
    salt = np.asarray(salt).astype(np.uint64)
    return mix(hashes ^ mix(salt + np.uint64(0x632BE59BD9B4E019)))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` word hashes, at the place where it starts."""
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = mix(total * np.uint64(_BASE) + words[k : k + count])
    return total


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its values; null is empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = pc.fill_null(column, "").cast(pa.large_string())
    else:
        column = pc.fill_null(column, b"").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of values that hold about ``PIECE`` bytes; a longer value is a run of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end
        at = end


@dataclass
class Texts:
    """Some texts: their bytes, offsets, and the byte range and text of every word."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, the number of its first word; one more entry at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        data = LOWER[self.data] if lower else self.data
        return range_hashes(byte_values(data), self.starts, self.ends)


def split_words(data: np.ndarray, offsets: np.ndarray) -> Texts:
    """Words are runs of bytes other than the six separators and never cross texts."""
    inside = ~IS_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Texts(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def each_piece(column: pa.Array) -> Iterator[tuple[int, int, Texts]]:
    """The words of a column, piece by piece: (first row, row after the last, words)."""
    data, offsets = byte_column(column)
    for at, end in pieces(offsets):
        own = offsets[at : end + 1]
        yield at, end, split_words(data[own[0] : own[-1]], own - own[0])
