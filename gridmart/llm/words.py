"""Words, their hashes and hashes of word windows, for whole Arrow columns of text at once.

A word is a maximal run of bytes other than U+0020 and U+0009-U+000D of the UTF-8 text; a null text
has none. Everything runs on the bytes of the Arrow buffer, in slices of whole documents, so memory
follows the slice (or the longest single text), never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000
_STEP = 1 << 18  # tables of powers grow by so many

_generator = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE = _generator.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASE = 0xD6E8FEB86659FD93 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of ``x`` spread over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number modulo 2^64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.known = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            factors = np.full(-(-n // _STEP) * _STEP, self.base, np.uint64)
            factors[0] = 1
            self.known = np.multiply.accumulate(factors)
        return self.known[:n]


_byte_powers = _Powers(_BASE)
_byte_inverses = _Powers(pow(_BASE, -1, 2**64))
_window_powers = _Powers(_WINDOW_BASE)
_window_inverses = _Powers(pow(_WINDOW_BASE, -1, 2**64))


@dataclass
class Words:
    """The words of the texts ``first`` .. ``first + len(counts)`` of a column.

    ``data`` holds the texts' bytes, ``starts`` and ``ends`` the words' places in it, ``bounds`` the
    index of each text's first word, and one more for the end.
    """

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    lower: bool = False

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return span_hashes(self.data, self.starts, self.ends, self.lower)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, as a polynomial in an odd number, by differences of sums."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    values = (_LOWER_BYTE if lower else _BYTE)[data]
    values *= _byte_powers.upto(len(data))
    np.cumsum(values, out=sums[1:])
    found = (sums[ends] - sums[starts]) * _byte_inverses.upto(len(data))[starts]
    return mixed(found + (ends - starts).astype(np.uint64))


def ranges(hashes: np.ndarray, starts: np.ndarray, lengths) -> np.ndarray:
    """Hashes of the word sequences ``starts`` .. ``starts + lengths``."""
    n = len(hashes)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _window_powers.upto(n))))
    inverse = _window_inverses.upto(n)[starts] if n else np.zeros(0, np.uint64)
    return mixed((sums[starts + lengths] - sums[starts]) * inverse)


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` words; those that cross texts are the caller's to leave."""
    n = max(0, len(hashes) - length + 1)
    return ranges(hashes, np.arange(n), length)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; a null row is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def words_of(column: pa.Array, lower: bool = False, size: int | None = None) -> Iterator[Words]:
    """The words of a column in slices of about ``size`` bytes; a longer text is one slice."""
    data, at = column_bytes(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + (size or SLICE_BYTES), "right")) - 1)
        part = data[at[lo] : at[hi]]
        edges = at[lo : hi + 1] - at[lo]
        word = ~_SPACE[part]
        before = np.empty_like(word)
        before[:1] = False
        before[1:] = word[:-1]
        inner = edges[1:-1][edges[1:-1] < len(part)]
        before[inner] = False
        starts = np.flatnonzero(word & ~before)
        after = np.empty_like(word)
        after[-1:] = False
        after[:-1] = word[1:]
        cut = inner[inner > 0] - 1
        after[cut] = False
        ends = np.flatnonzero(word & ~after) + 1
        yield Words(lo, part, starts, ends, np.searchsorted(starts, edges), lower)
        lo = hi


def signed(x: np.ndarray) -> pa.Array:
    """64-bit hashes as an Arrow column of longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
