"""Words of many texts at once, as hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

U64 = np.uint64


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: bytes that are part of a word: all but blank, tab, line feed, vertical tab, form feed, return
NOT_BLANK = ~_byte_set((0x20, 0x20), (0x09, 0x0D))
#: letters, digits and every byte of a character beyond ASCII
ALPHANUMERIC = _byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_RANDOM = np.random.Generator(np.random.PCG64(20240101))
_BYTE_VALUES = _RANDOM.integers(0, 2**64, 256, dtype=U64) | U64(1)
_LOWER_VALUES = _BYTE_VALUES.copy()
_LOWER_VALUES[0x41:0x5B] = _BYTE_VALUES[0x61:0x7B]
#: bytes that are hashed at once, for small intermediate arrays
_AT_ONCE = 1 << 20
_IN_WORD = 0x9E3779B97F4A7C15
#: multipliers of the two hashes of word sequences
_IN_SEQUENCE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of a number modulo 2**64, as many as were ever asked for."""

    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, U64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, 2 * len(self.values)), self.base, U64)
            steps[0] = 1
            self.values = np.multiply.accumulate(steps)
        return self.values[:n]


_word_powers = _Powers(_IN_WORD)
_powers = [_Powers(m) for m in _IN_SEQUENCE]
_inverses = [_Powers(pow(m, -1, 2**64)) for m in _IN_SEQUENCE]


@dataclass
class Words:
    """All words of a column of texts, one after the other."""

    bounds: np.ndarray  # of texts: text i has words bounds[i] to bounds[i + 1]
    hashes: np.ndarray  # of words
    starts: np.ndarray  # first byte of each word, in the column's bytes
    ends: np.ndarray  # byte after each word

    def sequences(self, n: int, variant: int = 0) -> np.ndarray:
        """The hash of ``n`` words from every place on, also across the ends of texts."""
        count = len(self.hashes) - n + 1
        if count <= 0:
            return np.zeros(0, U64)
        sums = np.zeros(len(self.hashes) + 1, U64)
        np.cumsum(self.hashes * _powers[variant].upto(len(self.hashes)), out=sums[1:])
        return mix((sums[n:] - sums[:-n]) * _inverses[variant].upto(count) + U64(n))

    def room(self) -> np.ndarray:
        """For every word the number of words from it to the end of its text."""
        per_text = np.diff(self.bounds)
        return np.repeat(self.bounds[1:], per_text) - np.arange(len(self.hashes))

    def texts(self) -> np.ndarray:
        """For every word the text it is in."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each text starts and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.fill_null("").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    all_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return all_bytes[ends[0] : ends[-1]], ends - ends[0]


def pieces(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text each; a longer text is a run of its own."""
    lengths = pa.compute.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def spans(flags: np.ndarray) -> list[dict]:
    """The runs of true flags, as ``start`` and ``end``."""
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0)).tolist()
    return [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]


def split(
    column: pa.Array | pa.ChunkedArray, word_bytes: np.ndarray = NOT_BLANK, lower: bool = False
) -> Words:
    """The words of all texts: longest runs of ``word_bytes``, A-Z like a-z if ``lower``."""
    data, offsets = column_bytes(column)
    inside = word_bytes[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(bounds, np.zeros(0, U64), starts, ends)
    lengths = ends - starts
    numbers = _LOWER_VALUES if lower else _BYTE_VALUES
    powers = _word_powers.upto(int(lengths.max()))
    before, hashes = np.concatenate([[0], np.cumsum(lengths)]), np.empty(len(starts), U64)
    edges = np.unique(np.searchsorted(before, np.arange(0, before[-1], _AT_ONCE)))
    for i, j in zip(edges, [*edges[1:], len(starts)]):
        # place of each byte in its word
        at = before[i:j] - before[i]
        place = np.arange(before[j] - before[i]) - np.repeat(at, lengths[i:j])
        own = data[starts[i] : ends[j - 1]][inside[starts[i] : ends[j - 1]]]
        hashes[i:j] = np.add.reduceat(numbers[own] * powers[place], at)
    return Words(bounds, mix(hashes + lengths.astype(U64)), starts, ends)


def lowest_places(values: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` values the place of its lowest; of equals the leftmost.

    The order is that of the values' high bits; places take the low ones.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    bits = U64(max(1, n - 1).bit_length())
    low = ((values >> bits) << bits) | np.arange(n, dtype=U64)
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: n - width + 1], low[width - span :])
    return (low & ((U64(1) << bits) - U64(1))).astype(np.int64)
