"""Words of whole texts as 64-bit hashes, worked out with numpy over Arrow's own buffers.

A word is a longest run of ``0-9``, ``a-z`` (after lower-casing A-Z) and characters beyond ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        full = np.full(max(n, SLICE_BYTES + 2), base, np.uint64)
        full[0] = 1
        have = np.cumprod(full, dtype=np.uint64)
        if n <= SLICE_BYTES + 2:
            _POWERS[int(base)] = have
    return have[:n]


@dataclass
class Words:
    """Words of some neighbouring rows: ``hash[offsets[i]:offsets[i + 1]]`` are those of row ``first + i``."""

    first: int
    offsets: np.ndarray
    hash: np.ndarray
    prefix: dict[int, np.ndarray]  # by length in bytes: the hash of so long a beginning, 0 where the word isn't longer

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and UTF-8 bytes of a string column, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows of at most ``most`` bytes, or of one longer row."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b
        a = b


def words(column: pa.Array, prefixes: tuple[int, ...] = ()) -> Iterator[Words]:
    """Hashes of all words of all rows, in slices of bounded memory (a single row is never cut)."""
    all_offsets, all_bytes = buffers(column)
    for a, b in slices(all_offsets):
        cut = all_offsets[a : b + 1] - all_offsets[a]
        data = _LOWER[all_bytes[all_offsets[a] : all_offsets[b]]]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = _WORD[data]
        starts_row = np.zeros(len(data) + 1, bool)
        starts_row[cut[:-1]] = True
        begins = inside[1:-1] & (~inside[:-2] | starts_row[:-1])
        ends = inside[1:-1] & (~inside[2:] | np.append(starts_row[1:-1], True)[: len(data)])
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
        undo = _powers(_BASE_INVERSE, len(data) + 1)[start]
        prefix = {}
        for n in prefixes:
            longer = end - start > n
            stop = np.where(longer, start + n, start)
            prefix[n] = np.where(longer, mix((sums[stop] - sums[start]) * undo + np.uint64(n)), np.uint64(0))
        yield Words(a, np.searchsorted(start, cut), mix((sums[end] - sums[start]) * undo), prefix)


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``n`` words, with offsets; a row of 1 to n - 1 words has one, of all its words."""
    count = np.diff(w.offsets)
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(made)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], made) + np.repeat(w.offsets[:-1], made)
    left = np.repeat(np.minimum(count, n), made)
    padded = np.concatenate([w.hash, np.zeros(n, np.uint64)])
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = mix(out + np.uint64(k + 1)) * np.uint64(0xD6E8FEB86659FD93) + np.where(k < left, padded[at + k], np.uint64(0))
    return mix(out), offsets
