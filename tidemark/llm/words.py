"""Words and word n-grams of whole Arrow batches, as 64-bit hashes computed with numpy.

A batch is cut into slices of rows of about ``SLICE_BYTES``; a longer text is a slice of its own and
its bytes are hashed in blocks, so memory follows the longest text, never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MASK = (1 << 64) - 1
#: Odd multipliers, so that their powers can be divided out again modulo 2**64.
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_tables: dict[int, np.ndarray] = {}


def byte_class(*separators: tuple[int, int]) -> np.ndarray:
    """Which bytes belong to words: all but those of the given ranges, both ends included."""
    inside = np.ones(256, dtype=bool)
    for low, high in separators:
        inside[low : high + 1] = False
    return inside


#: ``[^\x20\x09-\x0D]+``
SPACED = byte_class((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SAME = np.arange(256, dtype=np.uint8)


class Words(NamedTuple):
    """The words of a slice: row within the slice, byte range within the slice, and hash of each."""

    row: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each row, the index of its first word
    count: np.ndarray  # of each row, its number of words


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the power of 0 .. n - 1, modulo 2**64."""
    known = _tables.get(base)
    if known is None or len(known) < n:
        grown = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        grown[0] = 1
        known = _tables[base] = np.cumprod(grown, dtype=np.uint64)
    return known[:n]


def _ranges(values: np.ndarray, base: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A polynomial hash of ``values[start:stop]`` for each range."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=sums[1:])
    back = _powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mix((sums[stop] - sums[start]) * back[start])


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets within the bytes) of each run of rows; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(at, at[row] + SLICE_BYTES, side="right")) - 1)
        yield row, whole[at[row] : at[last]], at[row : last + 1] - at[row]
        row = last


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = SPACED, fold: np.ndarray = SAME) -> Words:
    """The words of a slice; ``fold`` replaces bytes first (``LOWER`` lower-cases A-Z)."""
    rows = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none.astype(np.uint64), np.zeros(rows, np.int64), np.zeros(rows, np.int64))
    data = fold[data]
    is_word = inside[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    edge[offsets] = True
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1] | edge[1:-1]
    ends = is_word.copy()
    ends[:-1] &= ~is_word[1:] | edge[1:-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    count = np.bincount(row, minlength=rows)
    hashes = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):  # blocks of whole words
        last = max(at + 1, int(np.searchsorted(stop, start[at] + SLICE_BYTES, side="right")))
        base = start[at]
        block = data[base : stop[last - 1]].astype(np.uint64) + np.uint64(1)
        hashes[at:last] = _ranges(block, _BYTE_BASE, start[at:last] - base, stop[at:last] - base)
        at = last
    return Words(row, start, stop, hashes, np.cumsum(count) - count, count)


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The index of the first word and the hash of each run of ``n`` words within a row."""
    if len(words.hash) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.row[: len(words.row) - n + 1] == words.row[n - 1 :])
    return at, _ranges(words.hash, _WORD_BASE, at, at + n)


def stretches(words: Words, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The hash of the words ``start:stop`` of each stretch."""
    return _ranges(words.hash, _WORD_BASE, start, stop)


def window_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling the reach of the minimum."""
    if len(keys) < width:
        return keys[:0]
    reach, low = 1, keys
    while reach * 2 <= width:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def signed(x: np.ndarray) -> np.ndarray:
    """Spark's long holds the same 64 bits."""
    return x.astype(np.uint64).view(np.int64)
