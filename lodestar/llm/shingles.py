"""Word-shingle sets as sorted 64-bit hashes, computed a slice of texts at a time.

A word is a maximal run of characters other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``) after lower-casing A-Z.  A document's set holds its
distinct ``width``-word shingles; with fewer words the whole word sequence is
the only shingle; without words, or with a null text, the set is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lodestar.llm import bytewords as bw

_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    w = bw.scan(column)
    hashed, counts = w.hashes(), w.counts
    n = len(hashed)
    length = np.minimum(counts, width)          # words per window of each text
    value = hashed.copy()
    for k in range(1, min(width, n)):
        mixed = (value[: n - k] ^ (value[: n - k] >> np.uint64(29))) * _MIX + hashed[k:]
        if (length[w.doc[: n - k]] > k).all():
            value[: n - k] = mixed
        else:
            value[: n - k] = np.where(length[w.doc[: n - k]] > k, mixed, value[: n - k])
    value = bw.finalise(value)
    windows = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.cumsum(counts) - counts
    sizes = np.zeros(len(counts), np.int64)
    parts = []
    for i in np.flatnonzero(windows):
        a = np.sort(value[first[i]: first[i] + windows[i]])
        if len(a) > 1:
            a = a[np.concatenate(([True], a[1:] != a[:-1]))]
        parts.append(a)
        sizes[i] = len(a)
    starts = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), starts


def batch_sets(texts, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, set)`` for every row in order; a set is ascending and distinct."""
    column = bw.strings(texts)
    for lo, hi in bw.slices(column):
        flat, starts = _sets(column.slice(lo, hi - lo), width)
        for i in range(hi - lo):
            yield lo + i, flat[starts[i]: starts[i + 1]]


def set_key(s: np.ndarray) -> bytes:
    """128-bit key of a set (equal sets have equal keys)."""
    n = np.uint64(len(s))
    with np.errstate(over="ignore"):
        a = bw.finalise(np.array([s.sum(dtype=np.uint64) + n], np.uint64))
        b = bw.finalise(np.array([np.bitwise_xor.reduce(s * (s >> np.uint64(7) | np.uint64(1)), initial=0) + n], np.uint64))
    return a.tobytes() + b.tobytes()
