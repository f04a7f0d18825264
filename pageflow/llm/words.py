"""Vectorised word hashing over Arrow string columns.

A whole Arrow batch is read as one byte buffer and handled with numpy: no Python
loop runs per word or per document. The buffer is cut into slices at word ends, so
the working memory is bounded by ``SLICE`` bytes whatever the length of a text.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D`` (``WORD``), or a run of ASCII
letters and non-ASCII bytes (``LETTERS``).
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 21
_BASE = 0x9E3779B97F4A7C13  # 3 mod 4: powers differ in their high bits
_MASK = (1 << 64) - 1

_bytes = np.arange(256)
WORD = ~((_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D)))
LETTERS = (((_bytes | 0x20) >= 0x61) & ((_bytes | 0x20) <= 0x7A)) | (_bytes >= 0x80)
LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes).astype(np.uint8)


class Words(NamedTuple):
    """Words of a batch: ``hash``, byte range in ``data``, and ``first[row] : first[row + 1]`` per row."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return values[LOWER] if lower else values


@lru_cache(maxsize=2)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; a null row is an empty range."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets if len(offsets) else np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, keep: np.ndarray):
    """Ranges of about ``SLICE`` bytes that end at word ends."""
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + SLICE)
        while to < n:  # move on to a byte that ends a word
            gap = np.flatnonzero(~keep[data[to - 1:to - 1 + SLICE]])
            if len(gap):
                to += int(gap[0])
                break
            to = min(n, to + SLICE)
        yield at, to
        at = to


def words_of(column: pa.Array, keep: np.ndarray = WORD, lower: bool = False) -> Words:
    """All words of a string column with a 64-bit hash each."""
    data, offsets = buffer_of(column)
    return words_in(data, offsets, keep, lower)


def words_in(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray = WORD, lower: bool = False) -> Words:
    """Words of the ranges ``offsets[i] : offsets[i + 1]`` of a byte buffer."""
    values = _byte_values(lower)
    inverse = pow(_BASE, -1, 1 << 64)
    hashes, starts, ends = [], [], []
    for a, b in slices(data, keep):
        part = data[a:b]
        inside = keep[part]
        cut = np.zeros(b - a + 1, dtype=bool)  # a row begins here
        lo, hi = np.searchsorted(offsets, [a, b])
        cut[offsets[lo:hi] - a] = True
        cut[0] = cut[-1] = True
        before = np.empty(b - a, dtype=bool)
        before[0] = False
        before[1:] = inside[:-1]
        start = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.empty(b - a, dtype=bool)
        after[-1] = False
        after[:-1] = inside[1:]
        end = np.flatnonzero(inside & (~after | cut[1:])) + 1
        n = max(SLICE, 1 << (b - a - 1).bit_length())
        total = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(values[part] * _powers(n, _BASE)[:b - a], out=total[1:])
        h = (total[end] - total[start]) * _powers(n, inverse)[start]
        hashes.append(mix(h + (end - start).astype(np.uint64)))
        starts.append(start + a)
        ends.append(end + a)
    if hashes:
        h, s, e = np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)
    else:
        h, s, e = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return Words(h, s, e, np.searchsorted(s, offsets), data)


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows, and each row's range of windows (``first`` as in :class:`Words`).

    Window ``j`` of a row starts at its word ``j``; a row of fewer than k words has none.
    """
    n = len(words.hash)
    counts = np.maximum(np.diff(words.first) - (k - 1), 0)
    first = np.concatenate(([0], np.cumsum(counts)))
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    total = words.hash[:n - k + 1].copy()
    for j in range(1, k):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words.hash[j:n - k + 1 + j]
    keep = np.repeat(words.first[:-1], counts) + (np.arange(first[-1]) - np.repeat(first[:-1], counts))
    return mix(total[keep]), first


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of every item, from each row's range."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sum_by_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i] : first[i + 1]]`` per row, 0 for an empty range."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64 if values.dtype.kind in "biu" else None)))
    return total[first[1:]] - total[first[:-1]]


def list_array(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and each row's range."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


def chain_of(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One order-sensitive hash of every run ``values[start[i] : end[i]]``; 0 for an empty run."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    n = max(SLICE, 1 << len(values).bit_length())
    np.cumsum(values * _powers(n, _BASE)[:len(values)], out=total[1:])
    h = (total[end] - total[start]) * _powers(n, inverse)[start]
    size = (end - start).astype(np.uint64)
    return np.where(size > 0, mix(h + size), np.uint64(0))


def chain(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """:func:`chain_of` of the runs ``values[first[i] : first[i + 1]]``."""
    return chain_of(values, first[:-1], first[1:])


def unique_in_rows(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (value, row) pairs, by row and then value."""
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], row[new]


def pieces(batches, text: str, most: int = 1 << 22):
    """Arrow batches cut to at most ``most`` bytes of ``text`` each (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if not len(column):
            continue
        _, offsets = buffer_of(column)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            to = min(to, len(column))
            yield batch.slice(at, to - at)
            at = to
