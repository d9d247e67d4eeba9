"""Words of Arrow text columns as 64-bit hashes, by array operations alone.

A word is a run of anything but blank, tab, line feed, vertical tab, form feed
and carriage return. No Python string is made: the column's own bytes are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: The same class of characters as a pattern for both SQL engines.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes hashed at once; longer texts are cut between words.
CHUNK = 1 << 20

#: Powers are made so many at a time, as many as are asked for: a worker keeps them.
POWERS = 1 << 16

_BASE = 0x9E3779B97F4A7C15
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_AS_IS = np.arange(1, 257, dtype=np.uint64)
_LOWER = _AS_IS.copy()
_LOWER[65:91] = _AS_IS[97:123]
_powers: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the argument; one to one."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the odd base below `n`, and their inverses modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = -(-n // POWERS) * POWERS
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))])
                      for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """`hashes` of all words of some rows; row i has those from bounds[i] to bounds[i + 1]."""

    hashes: np.ndarray
    bounds: np.ndarray
    heads: list[np.ndarray]  # for each asked length, the hash of the word's first bytes

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def _hashed(data: np.ndarray, offsets: np.ndarray, lower: bool, heads: tuple[int, ...]):
    """Hashes and byte starts of the words; a word ends where its row ends."""
    base = offsets[0]
    data = data[base:offsets[-1]]
    n = len(data)
    solid = ~_SEPARATOR[data]
    first = np.zeros(n + 1, bool)
    first[offsets - base] = True
    begins = solid & first[:-1]
    begins[1:] |= solid[1:] & ~solid[:-1]
    finishes = solid & first[1:]
    finishes[:-1] |= solid[:-1] & ~solid[1:]
    if n:
        finishes[-1] = solid[-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER if lower else _AS_IS)[data] * up[:n], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    cut = [mixed((sums[np.minimum(starts + k, ends)] - sums[starts]) * down[starts] + np.uint64(k)) for k in heads]
    return hashes, starts + base, cut


def _long_row(data: np.ndarray, lo: int, hi: int, lower: bool, heads: tuple[int, ...], chunk: int):
    """A row longer than a chunk, cut after separators; a longer word stays whole."""
    got, at = [], lo
    while at < hi:
        end = min(at + chunk, hi)
        if end < hi:
            gaps = np.flatnonzero(_SEPARATOR[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                while end < hi and not _SEPARATOR[data[end]]:
                    end += 1
        got.append(_hashed(data, np.array([at, end]), lower, heads))
        at = end
    return np.concatenate([g[0] for g in got]), [np.concatenate(x) for x in zip(*(g[2] for g in got))]


def row_words(column: pa.Array, lower: bool = True, heads: tuple[int, ...] = (),
              chunk: int = CHUNK) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, Words) for successive rows, about `chunk` bytes at once. Null and empty texts have no words."""
    text = column.cast(pa.large_string())
    if text.null_count:
        text = text.fill_null("")
    n = len(text)
    if not n:
        return
    _, where, held = text.buffers()
    offsets = np.frombuffer(where, np.int64)[text.offset:text.offset + n + 1]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + chunk, "right")) - 1))
        if offsets[hi] - offsets[lo] > chunk:
            hashes, cut = _long_row(data, int(offsets[lo]), int(offsets[hi]), lower, heads, chunk)
            yield lo, hi, Words(hashes, np.array([0, len(hashes)]), cut)
        else:
            hashes, starts, cut = _hashed(data, offsets[lo:hi + 1], lower, heads)
            yield lo, hi, Words(hashes, np.searchsorted(starts, offsets[lo:hi + 1]), cut)
        lo = hi
