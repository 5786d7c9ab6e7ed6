"""Words, lines and hashes of Arrow text columns, worked out in numpy over whole batches.

A word is a run of characters other than space and 0x09-0x0D. In UTF-8 these are single
bytes that no other character contains, so words are cut on the bytes themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
# The inverse of _BASE modulo 2**64: every odd number has one.
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all 64 bits; different inputs stay different."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def slices(column: pa.Array, most_bytes: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Cut a text column into runs of rows of about ``most_bytes``; a longer text is a run of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most_bytes:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; a null text is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(ends[0]), int(ends[-1])
    held = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.empty(0, np.uint8)
    return held, ends - first


@dataclass
class Words:
    """Words of some texts: bytes, where each word starts and ends, and the first word of each text."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The row of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False, skip: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial in its bytes, then mixed.

        ``lower`` folds ASCII letters; bytes marked in ``skip`` do not count.
        """
        data = self.data.astype(np.uint64)
        if lower:
            data = np.where((self.data >= 65) & (self.data <= 90), data + np.uint64(32), data)
        if not len(data):
            return np.empty(0, np.uint64)
        data += np.uint64(1)
        if skip is not None:
            data[skip] = 0
            place = np.concatenate([[0], np.cumsum(~skip)])
        else:
            place = np.arange(len(data) + 1)
        power, back = _powers(_BASE, len(data) + 1), _powers(_UNBASE, len(data) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * power[place[:-1]], dtype=np.uint64)])
        return mix((total[self.ends] - total[self.starts]) * back[place[self.starts]])

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def split_words(column: pa.Array, extra: np.ndarray | None = None) -> Words:
    """Cut every text of a column into words. ``extra`` marks further byte values as separators."""
    data, offsets = raw_bytes(column)
    space = np.zeros(256, bool)
    space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    if extra is not None:
        space |= extra
    inside = ~space[data]
    # A word also ends where its text does.
    begins, stops = inside.copy(), inside.copy()
    if len(data):
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of ``n`` words inside one text, and the index of its first word."""
    if len(hashes) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    count = len(hashes) - n + 1
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD1342543DE82EF95) + hashes[k : k + count]
    owner = words.owner
    whole = owner[:count] == owner[n - 1 :]
    return mix(out[whole]), np.flatnonzero(whole)
