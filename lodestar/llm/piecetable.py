"""Fill-in-middle transformation with piece tables (operator 11).

A document is a list of descriptors ``(buffer, start, length)`` over two
immutable buffers: the UTF-8 bytes of its Arrow column and the sentinels.
Cutting splits descriptors, an arrangement permutes them, the inverse
permutation restores the text, and hashes and outputs stream over the
descriptors, so no text is copied before it is written out.

A text is cut at token ends only (a token is a word with the white space before
it, or the white space at the end of the text), so every cut is a character
boundary.  Cuts and form depend on the seed and the row's id alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lodestar.llm import bytewords as bw

# The sentinels, and for each form the part (0 prefix, 1 middle,
# 2 suffix) that follows each sentinel.
SENTINELS = (b"<P>", b"<S>", b"<M>")
MARKS = b"".join(SENTINELS)
FORMS = {"psm": ((0, 0), (1, 2), (2, 1)), "spm": ((1, 2), (0, 0), (2, 1))}

TEXT, MARK = 0, 1           # numbers of the buffers


@dataclass(frozen=True)
class Pieces:
    """One document as descriptors over immutable buffers."""

    buffers: tuple[memoryview, memoryview]
    items: tuple[tuple[int, int, int], ...]

    @staticmethod
    def whole(text: memoryview, start: int = 0, length: int | None = None) -> Pieces:
        length = len(text) - start if length is None else length
        return Pieces((text, memoryview(MARKS)), ((TEXT, start, length),) if length else ())

    def cut(self, *offsets: int) -> list[Pieces]:
        """The document split at ascending byte offsets."""
        parts: list[list[tuple[int, int, int]]] = [[]]
        todo, at = list(offsets), 0
        for buffer, start, length in self.items:
            while todo and todo[0] <= at + length:
                left = todo.pop(0) - at
                if left:
                    parts[-1].append((buffer, start, left))
                parts.append([])
                start, length, at = start + left, length - left, at + left
            if length:
                parts[-1].append((buffer, start, length))
            at += length
        parts.extend([] for _ in todo)
        return [Pieces(self.buffers, tuple(p)) for p in parts]

    def mark(self, k: int) -> tuple[int, int, int]:
        return (MARK, sum(map(len, SENTINELS[:k])), len(SENTINELS[k]))

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, length in self.items:
            yield self.buffers[buffer][start: start + length]

    def bytes(self) -> bytes:
        return b"".join(self.stream())

    def sha256(self) -> str:
        h = hashlib.sha256()
        for view in self.stream():
            h.update(view)
        return h.hexdigest()


def arrange(parts: list[Pieces], form: str) -> Pieces:
    """Prefix, middle and suffix in the order of ``form``, each after its sentinel."""
    items: list[tuple[int, int, int]] = []
    for k, part in FORMS[form]:
        items.append(parts[0].mark(k))
        items.extend(parts[part].items)
    return Pieces(parts[0].buffers, tuple(items))


def restore_pieces(output: Pieces, form: str) -> Pieces:
    """Inverse of ``arrange`` on an output as read: its sentinels are found, cut
    out, and the parts put back in text order."""
    if form == "plain":
        return output
    raw, edges, at = output.bytes(), [], 0
    for k, _ in FORMS[form]:
        at = raw.index(SENTINELS[k], at)
        edges += [at, at + len(SENTINELS[k])]
        at = edges[-1]
    sections = output.cut(*edges)[2::2]
    back = [Pieces(output.buffers, ())] * 3
    for (_, part), section in zip(FORMS[form], sections, strict=True):
        back[part] = section
    return Pieces(output.buffers, tuple(d for p in back for d in p.items))


def draws(key, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a row: the first 8-digit groups of the hex digest."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i: i + 4], "big") for i in (0, 4, 8, 12))


def _code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _slice(column: pa.Array, keys: list, seed: int, rate: int, spm: int) -> Iterator[tuple]:
    """``(n, form, prefix_chars, middle_chars, pieces)`` of every row of one slice."""
    words = bw.scan(column)
    offsets = bw.offsets_of(column)
    sizes, base = np.diff(offsets), offsets[0]
    first = np.cumsum(words.counts) - words.counts
    marked = pc.or_(pc.or_(*(pc.match_substring(column, s.decode()) for s in SENTINELS[:2])),
                    pc.match_substring(column, SENTINELS[2].decode())).to_pylist()
    raw = column.buffers()[2]
    view = memoryview(raw) if raw is not None else memoryview(b"")
    data = np.frombuffer(view, np.uint8)
    for i, key in enumerate(keys):
        size, start, count = int(sizes[i]), int(offsets[i]), int(words.counts[i])
        last = int(words.end[first[i] + count - 1]) + base - start if count else 0
        n = count + (last < size)               # white space at the end is a token

        def end_of(token: int) -> int:
            if token == 0:
                return 0
            return int(words.end[first[i] + token - 1]) + base - start if token <= count else size  # noqa: B023

        whole = Pieces.whole(view, start, size)
        h1, h2, h3, h4 = draws(key, seed)
        if not size or marked[i] or h3 % 100 >= rate:
            yield n, "plain", None, None, whole
            continue
        form = "spm" if h4 % 100 < spm else "psm"
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = end_of(a), end_of(b)
        yield (n, form, _code_points(data[start: start + a]), _code_points(data[start + a: start + b]),
               arrange(whole.cut(a, b), form))


ADDED = ("n", "form", "prefix_chars", "middle_chars", "output", "output_sha256")


def fill_in_middle(documents: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42,
                   rate: int = 50, spm: int = 80) -> DataFrame:
    """All columns of ``documents`` and, for each row, ``n`` (tokens), ``form``
    (``plain``, ``psm`` or ``spm``), ``prefix_chars`` and ``middle_chars`` (code
    points; null if plain), ``output`` and the streamed ``output_sha256``.

    ``rate`` of 100 rows are transformed, ``spm`` of 100 of these suffix first.
    Empty, null (as empty) and marked texts (that hold a sentinel) stay plain; rows
    without a key draw as if the key were the empty string.  Repeated rows give
    repeated rows, texts of any length are one row.  Added columns replace any of
    the same names.  Rows keep their partitions: no shuffle.
    """
    base = documents.drop(*ADDED)
    at, by = base.columns.index(text), base.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = bw.strings(batch.column(at))
            for lo, hi in bw.slices(column):
                got = list(_slice(column.slice(lo, hi - lo), batch.column(by).slice(lo, hi - lo).to_pylist(), seed, rate, spm))
                n, form, prefix, middle, pieces = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                     pa.array([p.bytes() for p in pieces], pa.binary()).cast(pa.string()),
                     pa.array([p.sha256() for p in pieces], pa.string())], names=[*batch.schema.names, *ADDED])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields), "n long, form string",
                        "prefix_chars long, middle_chars long, output string, output_sha256 string"])
    return base.mapInArrow(run, schema)


def restore(outputs: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """All columns and ``restored``: the text rebuilt from ``output`` and ``form``
    alone.  An output that lacks a sentinel of its form fails the job."""
    base = outputs.drop("restored")
    at, by = base.columns.index(output), base.columns.index(form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = bw.strings(batch.column(at))
            for lo, hi in bw.slices(column):
                part = column.slice(lo, hi - lo)
                offsets, raw = bw.offsets_of(part), part.buffers()[2]
                view = memoryview(raw) if raw is not None else memoryview(b"")
                back = [restore_pieces(Pieces.whole(view, int(a), int(b - a)), f).bytes() for a, b, f in
                        zip(offsets[:-1], offsets[1:], batch.column(by).slice(lo, hi - lo).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns),
                                                  pa.array(back, pa.binary()).cast(pa.string())],
                                                 names=[*batch.schema.names, "restored"])

    return base.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields),
                                           "restored string"]))
