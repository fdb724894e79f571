"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A text never becomes Python word objects here: words are byte ranges, and a word is known by a
64-bit hash of its bytes. Work runs slice by slice, so memory follows the longest text, not the
batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BLOCK_BYTES = 1 << 20

# The two word rules: anything but ASCII blanks, and ASCII letters and digits plus all non-ASCII.
NON_BLANK = np.ones(256, bool)
NON_BLANK[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASE = 0xD1342543DE82EF95 | 1
_MASK = (1 << 64) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that sums of hashes keep no structure."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, kept up to one block."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n <= len(self.up):
            return self.up, self.down
        tables = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        if n <= 2 * BLOCK_BYTES:
            self.up, self.down = tables
        return tables


_POWERS = _Powers()


@dataclass
class Words:
    """Words of consecutive texts: byte ranges, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # texts + 1 positions into starts
    rows: slice  # of the batch

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of the bytes of every word."""
        out = np.empty(len(self.starts), np.uint64)
        a = 0
        while a < len(self.starts):
            b = int(np.searchsorted(self.ends, self.starts[a] + BLOCK_BYTES, "right"))
            b = max(b, a + 1)
            first, last = int(self.starts[a]), int(self.ends[b - 1])
            up, down = _POWERS(last - first)
            sums = np.zeros(last - first + 1, np.uint64)
            np.cumsum(
                (self.data[first:last].astype(np.uint64) + np.uint64(1)) * up[: last - first],
                out=sums[1:],
            )
            s, e = self.starts[a:b] - first, self.ends[a:b] - first
            out[a:b] = (sums[e] - sums[s]) * down[s]
            a = b
        return mixed(out)

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offset of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, at


def word_slices(
    column: pa.Array, inside: np.ndarray = NON_BLANK, lower: bool = False
) -> Iterator[Words]:
    """Words of a string column, some texts at a time; a long text comes alone."""
    raw, at = text_bytes(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + SLICE_BYTES, "right")) - 1)
        j = min(j, n)
        data = raw[at[i] : at[j]]
        bounds = at[i : j + 1] - at[i]
        if lower:
            data = LOWER[data]
        word = inside[data]
        edge = word.copy()
        edge[1:] &= ~word[:-1]
        cuts = bounds[:-1][bounds[:-1] < len(data)]
        edge[cuts] = word[cuts]
        starts = np.flatnonzero(edge)
        edge = word.copy()
        edge[:-1] &= ~word[1:]
        cuts = bounds[1:][bounds[1:] > 0] - 1
        edge[cuts] = word[cuts]
        ends = np.flatnonzero(edge) + 1
        yield Words(data, starts, ends, np.searchsorted(starts, bounds), slice(i, j))
        i = j


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp value of every k consecutive hashes, modulo 2^64 and scrambled.

    Built by doubling, which gives the same polynomial as rolling and needs no table of powers.
    """
    if len(h) < k:
        return np.empty(0, np.uint64)
    n = len(h) - k + 1
    out, done, width, span = np.zeros(n, np.uint64), 0, 1, h
    while True:
        if k & width:
            out += span[done : done + n] * np.uint64(pow(_WINDOW_BASE, done, 1 << 64))
            done += width
        if done == k:
            return mixed(out)
        factor = np.uint64(pow(_WINDOW_BASE, width, 1 << 64))
        span = span[: len(span) - width] + span[width:] * factor
        width *= 2


def whole_windows(offsets: np.ndarray, k: int) -> np.ndarray:
    """Starts of the windows of k words that stay inside one text, given all texts' words."""
    total = int(offsets[-1]) if len(offsets) else 0
    if total < k:
        return np.empty(0, np.int64)
    keep = np.ones(total - k + 1, bool)
    for back in range(1, k):
        at = offsets[1:-1] - back
        at = at[(at >= 0) & (at < len(keep))]
        keep[at] = False
    return np.flatnonzero(keep)


def covered(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Which of n words lie in a window of k words at one of the starts."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + k, -1)
    return np.cumsum(steps[:-1]) > 0
