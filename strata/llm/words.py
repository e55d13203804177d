"""Words, their hashes and n-gram hashes over whole Arrow text columns, as arrays instead of loops.

Word boundaries are ASCII bytes, so they can be found in the UTF-8 bytes of a column. All hashes are 64-bit
polynomials over prefix sums: any span of bytes or words gets its hash from two sums. Rows are taken in pieces of
bounded bytes; one row that is longer is a piece of its own, so a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
# One random 64-bit value per byte value, the same in every process.
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def as_long(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.view(np.int64)


@lru_cache(maxsize=4)
def _powers_of(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each."""
    return _powers_of(1 << max(12, int(size).bit_length()))


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair, equal for equal content wherever it stands."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Piece:
    """Some consecutive rows of a text column."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lo: int):
        #: Bytes of the texts, where each text starts and ends in them, and the number of the first row.
        self.data, self.bounds, self.lo = data, bounds, lo
        self.rows = len(bounds) - 1

    def words(self, word_bytes: np.ndarray | None = None) -> Words:
        return Words(self, ~SPACE if word_bytes is None else word_bytes)


class Words:
    """The words of a piece: byte spans, and the first word of each row (with the end as last entry)."""

    def __init__(self, piece: Piece, word_bytes: np.ndarray):
        self.piece = piece
        inside = np.zeros(len(piece.data) + 2, bool)
        inside[1:-1] = word_bytes[piece.data]
        edge = inside[1:] != inside[:-1]
        cut = piece.bounds[1:-1]
        # A word never runs from one row into the next.
        joined = cut[inside[cut] & inside[cut + 1]] if len(cut) else cut
        steps = np.flatnonzero(edge)
        self.start, self.end = steps[::2], steps[1::2]
        if len(joined):
            joined = np.unique(joined)
            self.start = np.sort(np.concatenate([self.start, joined]))
            self.end = np.sort(np.concatenate([self.end, joined]))
        self.first = np.searchsorted(self.start, piece.bounds)
        self.first[-1] = len(self.start)
        self.counts = np.diff(self.first)
        #: The row of each word.
        self.row = np.repeat(np.arange(piece.rows), self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return span_hashes(_BYTE_VALUES[self.piece.data], self.start, self.end)

    def byte_sums(self, chosen: np.ndarray) -> np.ndarray:
        """For each word, how many of its bytes are among the chosen byte values."""
        sums = np.zeros(len(self.piece.data) + 1, np.int64)
        np.cumsum(chosen[self.piece.data], out=sums[1:])
        return sums[self.end] - sums[self.start]


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` values, rows disregarded; callers mask runs that cross a row."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    start = np.arange(len(hashes) - size + 1)
    return span_hashes(hashes, start, start + size)


def pieces(column: pa.Array | pa.ChunkedArray, table: np.ndarray | None = None) -> Iterator[Piece]:
    """The column in pieces of bounded bytes, null as empty, bytes translated by ``table`` if given."""
    for array in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        array = array.fill_null("").cast(pa.large_string()) if array.null_count else array.cast(pa.large_string())
        if not len(array):
            continue
        offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        buffer = array.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(array):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE_BYTES, side="right")) - 1)
            part = data[offsets[lo] : offsets[hi]]
            yield Piece(part if table is None else table[part], offsets[lo : hi + 1] - offsets[lo], lo)
            lo = hi


def sums_by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row, rows given by their first entry and the end."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, dtype=np.int64))


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """Arrow lists of the given lengths over the values in order."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
