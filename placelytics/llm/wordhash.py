"""Words of a column of texts as arrays: bounds and 64-bit hashes, computed for many texts at once.

Works on the UTF-8 bytes of Arrow columns with numpy. Equal words always get equal hashes; unequal
ones practically never do (64 bits). A block holds about ``BLOCK`` bytes of text, or one longer text,
so the arrays made of it stay small whatever the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
_M = (1 << 64) - 1
_Q = 0xD1342543DE82EF95
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)

#: Word bytes: all but tab to carriage return and space; and letters, digits, non-ASCII.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False

_LOWER = np.arange(256)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, (self.base,)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, size, 1 << 64))])
        return self.up, self.down


_WORDS, _WORDS2 = _Powers(_Q), _Powers(0xDA942042E4DD58B5)


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` of runs of texts; a null is an empty text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1)
        last = min(last, len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = NOT_BLANK):
    """``(starts, ends, firsts)``: byte bounds of every word; words of text i are firsts[i]:firsts[i+1]."""
    inside = word_bytes[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    full = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[full] = inside[full]
    full = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stops[full] = inside[full]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, *, lower: bool = False) -> np.ndarray:
    """A hash of each word's bytes; ``lower`` takes A-Z as a-z."""
    sizes = ends - starts
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(firsts[-1]) - np.repeat(firsts[:-1], sizes)
    values = (_BYTE[_LOWER] if lower else _BYTE)[data[place + np.repeat(starts, sizes)]]
    # A factor of its own for each place in a word: powers of one number would let regular words collide.
    values *= (mixed(np.arange(int(sizes.max(initial=0)), dtype=np.uint64)) | np.uint64(1))[place]
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return mixed(total[firsts[1:]] - total[firsts[:-1]] + sizes.astype(np.uint64))


def gram_hashes(word_hashes: np.ndarray, size: int, *, second: bool = False) -> np.ndarray:
    """A hash of every run of ``size`` words; ``second`` is a family independent of the first."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = (_WORDS2 if second else _WORDS).upto(len(word_hashes) + 1)
    values = (mixed(word_hashes ^ np.uint64(0xA5A5A5A55A5A5A5A)) if second else word_hashes) * up[: len(word_hashes)]
    total = np.zeros(len(word_hashes) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return mixed((total[size:] - total[:-size]) * down[:n])


def run_hashes(word_hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of words from ``starts`` up to ``ends``, of the second family."""
    up, down = _WORDS2.upto(len(word_hashes) + 1)
    total = np.zeros(len(word_hashes) + 1, np.uint64)
    np.cumsum(mixed(word_hashes ^ np.uint64(0xA5A5A5A55A5A5A5A)) * up[: len(word_hashes)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
