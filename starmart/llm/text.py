"""Word positions and hashes of whole texts, computed on Arrow buffers with numpy.

A word is a maximal run of bytes outside the separators (space and 0x09-0x0D by default).
Separators are ASCII, so working on UTF-8 bytes gives the same words as on code points.
Word hashes are 64-bit: a random value per byte times a power of an odd base, summed by a
running sum over the buffer and shifted back to the word's start, then mixed. All tables
come from fixed seeds, so every task on every machine computes the same hashes.

Memory: a caller passes slices of bounded size (``slices``); hashing needs a few times
``SEGMENT`` x 8 bytes whatever the slice, also for one very long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 19
SLICE_BYTES = 2 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    data: np.ndarray     # uint8 text bytes of all rows
    start: np.ndarray    # int64 first byte of each word
    end: np.ndarray      # int64 byte after each word
    row: np.ndarray      # int64 row of each word
    first: np.ndarray    # int64 per row + 1: index of the row's first word
    hash: np.ndarray     # uint64 per word


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection on 64-bit words that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values of a seed."""
    with np.errstate(over="ignore"):
        start = mix(np.array([seed * 2 + 1], dtype=np.uint64) * _GOLD)
        return mix(start + np.arange(1, n + 1, dtype=np.uint64) * _GOLD)


@lru_cache(maxsize=None)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    mod = 1 << 64
    inverse = pow(base, -1, mod)
    ones = np.ones(n + 1, dtype=np.uint64)
    up, down = ones.copy(), ones.copy()
    up[1:] = np.uint64(base)
    down[1:] = np.uint64(inverse)
    return np.cumprod(up), np.cumprod(down)


_BASE = 0x9FB21C651E98DF25
_BYTE = stream(11, 256)
_FOLD = _BYTE.copy()
_FOLD[65:91] = _BYTE[97:123]


def separators(keep_alnum_only: bool = False) -> np.ndarray:
    """Byte table: True where a byte separates words."""
    sep = np.zeros(256, dtype=bool)
    if keep_alnum_only:
        sep[:128] = True
        for lo, hi in ((48, 58), (65, 91), (97, 123)):
            sep[lo:hi] = False
        return sep
    sep[[32, *range(9, 14)]] = True
    return sep


_SPACE = separators()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` text bytes (or one row)."""
    if not batch.num_rows:
        return
    _, off = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def running_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent hashes of the ranges [start, end) of a short value array."""
    up, down = _powers(_BASE, max(SEGMENT, 1 << (len(values)).bit_length()))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return (total[end] - total[start]) * down[start]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray,
                fold: bool = False) -> np.ndarray:
    """64-bit hash of each word, in segments of bounded size."""
    table = _FOLD if fold else _BYTE
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        to = int(np.searchsorted(end, start[at] + SEGMENT, side="right"))
        to = max(to, at + 1)
        lo, hi = int(start[at]), int(end[to - 1])
        out[at:to] = running_hash(table[data[lo:hi]], start[at:to] - lo, end[at:to] - lo)
        at = to
    return mix(out + (end - start).astype(np.uint64) * _GOLD)


def words(column: pa.Array, fold: bool = False, sep: np.ndarray = _SPACE) -> Words:
    """Words of every row of a string column (``fold``: hash A-Z as a-z)."""
    data, off = buffers(column)
    inside = ~sep[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    edges = off[:-1][off[:-1] < off[1:]]
    before[edges] = False                      # a row's first byte starts a word
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False        # a row's last byte ends one
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, off).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1, dtype=np.int64), np.diff(first))
    return Words(data, start, end, row, first, word_hashes(data, start, end, fold))


def grams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, valid) of the ``n`` words from each position; invalid where the row ends."""
    size = len(h) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    out = np.empty(size, dtype=np.uint64)
    for at in range(0, size, SEGMENT):
        to = min(at + SEGMENT, size)
        part = h[at:to + n - 1]
        begin = np.arange(to - at)
        out[at:to] = running_hash(part, begin, begin + n)
    return mix(out ^ np.uint64(n)), row[:size] == row[n - 1:]


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """``pick`` over ``width`` consecutive values, by doubling (log2(width) passes)."""
    if len(values) < width:
        return values[:0]
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:len(out) - step], out[step:])
        have += step
    return out


def window_minima(h: np.ndarray, row: np.ndarray, window: int, q: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser of each window of ``window`` words: the least hash of its ``q``-grams.

    Returns (minimum, valid) by window start. Equal windows have equal minima wherever
    they stand, so a minimum is a content-selected anchor of the window.
    """
    g, _ = grams(h, row, q)
    low = sliding(g, window - q + 1)
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    return low[:n], row[:n] == row[window - 1:]


def anchor_positions(h: np.ndarray, row: np.ndarray, window: int, q: int) -> np.ndarray:
    """Positions whose ``q``-gram is the minimiser of some window of ``window`` words."""
    low, ok = window_minima(h, row, window, q)
    if not ok.any():
        return np.zeros(0, np.int64)
    g, _ = grams(h, row, q)
    reach = window - q + 1
    best = np.zeros(len(low) + 2 * (reach - 1), dtype=np.uint64)
    best[reach - 1:reach - 1 + len(low)] = np.where(ok, low, np.uint64(0))
    top = sliding(best, reach, np.maximum)     # largest minimum of the windows over a position
    n = min(len(top), len(g))
    return np.flatnonzero((top[:n] == g[:n]) & (top[:n] > 0))


def span_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the word sequences h[start:end] (any lengths, one row each)."""
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        to = at + 1
        if end[at] - start[at] < SEGMENT:
            top = np.maximum.accumulate(end[at:])
            to = at + max(1, int(np.searchsorted(top, start[at] + SEGMENT, side="right")))
        lo, hi = int(start[at:to].min()), int(end[at:to].max())
        out[at:to] = running_hash(h[lo:hi], start[at:to] - lo, end[at:to] - lo)
        at = to
    return mix(out + (end - start).astype(np.uint64) * _GOLD)
