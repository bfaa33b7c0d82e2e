"""Words of Arrow string columns as byte spans and 64-bit hashes, vectorised.

The UTF-8 buffer of the column is classified byte by byte with a table, so
there is no Python work per word.  ASCII A-Z are lower-cased; other bytes stay.
A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

# Word bytes: everything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# Word bytes: ASCII digits and letters, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def finalise(h: np.ndarray) -> np.ndarray:
    """Bijective avalanche of 64-bit values, so that any range of bits is uniform."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_ODD = 0x9E3779B97F4A7C15
_TABLE = finalise(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_up = _down = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse modulo 2^64."""
    global _up, _down
    if len(_up) <= n:
        size = 1 << int(n).bit_length()
        for name, base in (("_up", _ODD), ("_down", pow(_ODD, -1, 1 << 64))):
            p = np.full(size + 1, base, np.uint64)
            p[0] = 1
            globals()[name] = np.multiply.accumulate(p)
    return _up, _down


@dataclass
class Words:
    """``doc[i]``: text of word i; ``start``/``end``: its bytes in ``data`` (lower-cased)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    counts: np.ndarray

    def hashes(self) -> np.ndarray:
        up, down = _powers(len(self.data))
        prefix = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_TABLE[self.data] * up[: len(self.data)], out=prefix[1:])
        return finalise((prefix[self.end] - prefix[self.start]) * down[self.start])


def strings(column) -> pa.Array:
    """One plain string array without nulls (a null becomes the empty text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    return column.fill_null("") if column.null_count else column


def offsets_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)


def scan(column: pa.Array, kept: np.ndarray = NOT_SPACE) -> Words:
    """Words of ``column`` (from ``strings``)."""
    offs = offsets_of(column)
    raw = column.buffers()[2]
    data = (np.frombuffer(raw, np.uint8)[offs[0]: offs[-1]] if raw is not None and offs[-1] > offs[0]
            else np.zeros(0, np.uint8))
    offs = offs - offs[0]
    data = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kept[data]
    begins = inside[1:-1] & ~inside[:-2]
    at = offs[:-1][offs[:-1] < len(data)]
    begins[at] |= inside[1:-1][at]          # a text begins a word of its own
    stops = inside[1:-1] & ~inside[2:]
    at = offs[1:][offs[1:] > 0] - 1
    stops[at] |= inside[1:-1][at]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    upto = np.searchsorted(start, offs)
    counts = np.diff(upto)
    return Words(data, start, end, np.repeat(np.arange(len(counts)), counts), counts)


def slices(column: pa.Array, most_bytes: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of at most that many bytes (one longer text stands alone)."""
    offs, lo = offsets_of(column), 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most_bytes, "right")) - 1)
        yield lo, min(hi, len(column))
        lo = hi
