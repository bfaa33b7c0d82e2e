"""Benchmark decontamination with an FM-index per shard of texts (operator 4).

A shard is a run of texts of bounded size inside a task.  Its words become
symbols of the phrases' vocabulary; a word that no phrase has ends a run, and runs
shorter than the shortest phrase cannot hold one, so only the other runs are
indexed (the same result as over all words).  The index has the suffix array
order of the runs (every run ends in a separator of its own), the
Burrows-Wheeler transform in a wavelet matrix for ranks, and suffix
positions sampled every SAMPLE words and at the start of every run.  All phrases are
searched backwards together, the occurrences are located by walking to a sampled
position, and the spans they cover are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import bytewords as bw
from lodestar.llm import scratch

SHARD_BYTES = 2 << 20       # bytes of text per index
SAMPLE = 16
BLOCK_BYTES = 8 << 20       # bytes of phrase texts that are searched together
PIECE_WORDS = 50_000        # longer items are cut
ADDED = ("n_words", "n_hit", "items", "spans")
_SPANS = "array<struct<start: bigint, end: bigint>>"


# --- phrases -------------------------------------------------------------------

@dataclass
class Phrases:
    """Distinct windows as rows of symbols (1..V, 0 pads short ones at the left)."""

    vocabulary: np.ndarray      # sorted word hashes; symbol = position + 1
    windows: np.ndarray         # (n, width)
    length: np.ndarray          # (n,)
    owner_window: np.ndarray    # pairs (window, item), by window
    owner_item: np.ndarray
    items: list[str | None]

    @property
    def shortest(self) -> int:
        return int(self.length.min()) if len(self.length) else 0


def phrases_of(ids: list, texts: list, width: int) -> Phrases:
    """Windows of ``width`` words of each item; an item of fewer is one window."""
    w = bw.scan(bw.strings(pa.array(texts, pa.string())), bw.ALNUM)
    vocabulary, symbol = np.unique(w.hashes(), return_inverse=True)
    symbol = symbol.astype(np.int64) + 1
    names = sorted({str(i) for i in ids if i is not None}) + [None] * any(i is None for i in ids)
    place = {name: k for k, name in enumerate(names)}
    item_of = [place[i if i is None else str(i)] for i in ids]
    rows, owner, at = [], [], 0
    for i, n in enumerate(w.counts):
        s = symbol[at: at + n]
        at += n
        if n >= width:
            rows.append(np.lib.stride_tricks.sliding_window_view(s, width))
        elif n:
            rows.append(np.concatenate([np.zeros(width - n, np.int64), s])[None, :])
        else:
            continue
        owner.append(np.full(len(rows[-1]), item_of[i]))
    if not rows:
        return Phrases(vocabulary, np.zeros((0, width), np.int64), np.zeros(0, np.int64),
                       np.zeros(0, np.int64), np.zeros(0, np.int64), names)
    windows, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.reshape(-1), np.concatenate(owner)], axis=1), axis=0)
    return Phrases(vocabulary, windows, (windows > 0).sum(axis=1), pairs[:, 0], pairs[:, 1], names)


# --- index ---------------------------------------------------------------------

def suffix_order(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``; zeros are separators, each taken as
    smaller than the next and all as smaller than any word.  Prefix doubling that
    sorts only the suffixes whose place is still open."""
    n = len(text)
    separators = int((text == 0).sum())
    key = np.where(text == 0, np.cumsum(text == 0) - 1, text + separators)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    head = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    place = np.flatnonzero(head)[np.cumsum(head) - 1]       # first row of one's class
    rank = np.empty(n, np.int64)
    rank[order] = place
    size = np.diff(np.append(np.flatnonzero(head), n))
    rows = np.flatnonzero(np.repeat(size, size) > 1)
    step = 1
    while len(rows):
        at = order[rows]
        second = rank[np.minimum(at + step, n - 1)]         # a separator ends every comparison
        sub = np.lexsort((second, rank[at]))
        at, second = at[sub], second[sub]
        order[rows] = at
        first = rank[at]
        head = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        rank[at] = rows[np.flatnonzero(head)[np.cumsum(head) - 1]]
        size = np.diff(np.append(np.flatnonzero(head), len(rows)))
        rows = rows[np.repeat(size, size) > 1]
        step *= 2
    return order


class WaveletMatrix:
    """Ranks of symbols in prefixes of a sequence, for many queries at once."""

    def __init__(self, sequence: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (sequence >> level) & 1
            ones = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(sequence) - int(ones[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        # Where each symbol begins in the sequence below the last level.
        self.base = self._down(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, level in enumerate(reversed(range(self.levels))):
            ones = self.ones[k][at]
            at = np.where((symbol >> level) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``at``."""
        return self._down(symbol, at) - self.base[symbol]


class FMIndex:
    def __init__(self, text: np.ndarray, top: int):
        """``text``: symbols 1..top, every run followed by a 0."""
        n = len(text)
        order = suffix_order(text)
        self.bwt = text[order - 1]
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.tree = WaveletMatrix(self.bwt, top)
        previous = np.concatenate(([0], text[:-1]))
        kept = (order % SAMPLE == 0) | (previous[order] == 0)
        self.sampled = np.where(kept, order, -1) if n else order

    def search(self, windows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that begin with each window."""
        n = len(self.bwt)
        lo, hi = np.zeros(len(windows), np.int64), np.full(len(windows), n, np.int64)
        width = windows.shape[1]
        for k in range(width):
            live = np.flatnonzero((length > k) & (hi > lo))
            if not len(live):
                break
            c = windows[live, width - 1 - k]
            lo[live] = self.below[c] + self.tree.rank(c, lo[live])
            hi[live] = self.below[c] + self.tree.rank(c, hi[live])
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in these rows."""
        at, steps, out = rows.copy(), 0, np.full(len(rows), -1, np.int64)
        live = np.arange(len(rows))
        while len(live):
            found = self.sampled[at[live]]
            done = found >= 0
            out[live[done]] = found[done] + steps
            live = live[~done]
            c = self.bwt[at[live]]
            at[live] = self.below[c] + self.tree.rank(c, at[live])
            steps += 1
        return out


def shard_hits(words: bw.Words, hashes: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hit, doc, item)``: hit words of the shard; distinct pairs of text and item."""
    nothing = np.zeros(len(hashes), bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(p.length) or not len(hashes):
        return nothing
    symbol = np.searchsorted(p.vocabulary, hashes)
    symbol = np.where(p.vocabulary[np.minimum(symbol, len(p.vocabulary) - 1)] == hashes, symbol + 1, 0)
    known = symbol > 0
    if not known.any():
        return nothing
    first = known.copy()
    first[1:] &= ~known[:-1] | (words.doc[1:] != words.doc[:-1])
    begin = np.flatnonzero(first)
    run = np.cumsum(first) - 1                      # run of each known word
    size = np.bincount(run[known], minlength=len(begin))
    long = size >= p.shortest
    kept = np.flatnonzero(known & long[np.maximum(run, 0)])
    if not len(kept):
        return nothing
    # Runs one after the other, each followed by a separator.
    shift = np.cumsum(long) - 1
    place = np.arange(len(kept)) + shift[run[kept]]
    text = np.zeros(len(kept) + int(long.sum()), np.int64)
    text[place] = symbol[kept]
    origin = np.full(len(text), -1, np.int64)
    origin[place] = kept
    index = FMIndex(text, len(p.vocabulary))
    lo, hi = index.search(p.windows, p.length)
    found = np.flatnonzero(hi > lo)
    count = (hi - lo)[found]
    which = np.repeat(found, count)
    rows = np.repeat(lo[found] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(len(which))
    start = origin[index.locate(rows)]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + p.length[which], -1)
    # Pairs of text and window, then the items that own the window.
    pair = np.unique(np.stack([words.doc[start], which], axis=1), axis=0) if len(which) else np.zeros((0, 2), np.int64)
    a, b = np.searchsorted(p.owner_window, pair[:, 1]), np.searchsorted(p.owner_window, pair[:, 1], "right")
    owners = np.repeat(a - np.concatenate(([0], np.cumsum(b - a)[:-1])) if len(a) else a, b - a) + np.arange(int((b - a).sum()))
    pairs = np.unique(np.stack([np.repeat(pair[:, 0], b - a), p.owner_item[owners]], axis=1), axis=0)
    return np.cumsum(cover[:-1]) > 0, pairs[:, 0], pairs[:, 1]


# --- operator ----------------------------------------------------------------

def pieces(benchmark: DataFrame, item: str, text: str, width: int) -> DataFrame:
    """``i, t``: the items' texts, long ones cut into pieces that overlap by ``width - 1`` words and so
    have the same windows.  Equal rows come once; texts without words have no window and are left out."""
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (t or "").encode("utf-8")
                w = bw.scan(bw.strings(pa.array([t], pa.string())), bw.ALNUM)
                n = int(w.counts[0])
                for a in range(0, max(n - width, 0) + 1 if n else 0, PIECE_WORDS):
                    ids.append(i)
                    texts.append(raw[w.start[a]: w.end[min(a + PIECE_WORDS + width - 1, n) - 1]].decode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["i", "t"])

    return rows.mapInArrow(run, "i string, t string").distinct()


def _block(phrases: DataFrame, k: int, blocks: int, width: int) -> Phrases:
    got = phrases.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect()
    return phrases_of([r.i for r in got], [r.t for r in got], width)


def _examine(column: pa.Array, p: Phrases) -> tuple[bw.Words, np.ndarray, list[set[str | None]]]:
    words = bw.scan(column, bw.ALNUM)
    hit, docs, owners = shard_hits(words, words.hashes(), p)
    items = [set() for _ in range(len(words.counts))]
    for d, i in zip(docs.tolist(), owners.tolist(), strict=True):
        items[d].add(p.items[i])
    return words, hit, items


def _inside(words: bw.Words, spans: list, offsets: np.ndarray) -> np.ndarray:
    """Words inside the given byte spans of their texts."""
    flat = [(int(offsets[d]) + s["start"], int(offsets[d]) + s["end"]) for d, of in enumerate(spans) for s in of]
    if not flat or not len(words.start):
        return np.zeros(len(words.start), bool)
    begin, end = np.array(sorted(flat), np.int64).T
    at = np.searchsorted(begin, words.start, "right") - 1
    return (at >= 0) & (words.end <= end[np.maximum(at, 0)])


def _spans(words: bw.Words, hit: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int]]]:
    """Merged byte spans of the hit words of each text."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(words.counts))]
    if hit.any():
        joined = hit.copy()
        joined[0] = False
        joined[1:] &= hit[:-1] & (words.doc[1:] == words.doc[:-1])
        begin = np.flatnonzero(hit & ~joined)
        end = np.flatnonzero(hit & ~np.append(joined[1:], False))
        for a, b in zip(begin, end, strict=True):
            d = words.doc[a]
            out[d].append((int(words.start[a] - offsets[d]), int(words.end[b] - offsets[d])))
    return out


def _columns(words: bw.Words, hit: np.ndarray, items: list, offsets: np.ndarray) -> list[pa.Array]:
    """The columns ADDED of one shard."""
    return [pa.array(words.counts, pa.int64()), pa.array(np.bincount(words.doc[hit], minlength=len(words.counts)), pa.int64()),
            pa.array([sorted(x - {None}) + [None] * (None in x) for x in items], pa.list_(pa.string())),
            pa.array([[{"start": a, "end": b} for a, b in s] for s in _spans(words, hit, offsets)],
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    raw, at, parts = text.encode("utf-8"), 0, []
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"\n".join([*parts, raw[at:]]).decode("utf-8")


def _searched(state: DataFrame, phrases: DataFrame, blocks: int, width: int) -> DataFrame:
    """``state(row, t, first)`` with ``n_words, n_hit, items, spans`` of the phrases of all blocks.  Every block is
    one pass, so tasks and driver hold the phrases of one block; what is found so far goes along, written."""
    spark = state.sparkSession
    found = state.selectExpr("*", "0L as n_words", "0L as n_hit", "cast(array() as array<string>) as items", f"cast(array() as {_SPANS}) as spans")
    for k in range(blocks):
        sent = spark.sparkContext.broadcast(_block(phrases, k, blocks, width))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole = bw.strings(batch.column("t"))
                for lo, hi in bw.slices(whole, SHARD_BYTES):
                    part, column = batch.slice(lo, hi - lo), whole.slice(lo, hi - lo)
                    offsets = bw.offsets_of(column)
                    offsets = offsets - offsets[0]
                    words, hit, items = _examine(column, sent.value)
                    hit |= _inside(words, part.column("spans").to_pylist(), offsets)
                    items = [x.union(y) for x, y in zip(items, part.column("items").to_pylist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in ("row", "t", "first")] + _columns(words, hit, items, offsets),
                                                     names=["row", "t", "first", *ADDED])

        before, found = found, scratch.stage(found.mapInArrow(run, found.schema), "hits")
        sent.destroy()
        if hasattr(before, "scratch_path"):
            scratch.discard(before)
    return found


def _cut(found: DataFrame) -> DataFrame:
    """``row, t, first`` of the rows with spans, these replaced by line breaks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_without(t, [(s["start"], s["end"]) for s in spans])
                     for t, spans in zip(b.column("t").to_pylist(), b.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string()), b.column("first")], names=["row", "t", "first"])
    rows = found.where("size(spans) > 0")
    return rows.mapInArrow(run, rows.select("row", "t", "first").schema)


def _in_passes(base: DataFrame, phrases: DataFrame, blocks: int, text: str, width: int, clean: bool) -> DataFrame:
    """``decontaminate`` for phrases of several blocks."""
    first = f"struct<n_words: bigint, n_hit: bigint, items: array<string>, spans: {_SPANS}>"
    state = base.select(F.struct("*").alias("row"), F.col(f"`{text}`").cast("string").alias("t"), F.lit(None).cast(first).alias("first"))
    done = None
    while True:
        found = _searched(state, phrases, blocks, width).withColumn("first", F.coalesce("first", F.struct(*ADDED)))
        ready = found.where("size(spans) = 0") if clean else found
        done = ready if done is None else done.unionByName(ready)
        if not clean or found.where("size(spans) > 0").isEmpty():
            break
        state = _cut(found)
    columns = [F.col("t" if c == text else f"row.`{c}`").alias(c) for c in base.columns]
    return done.select(*columns, *(F.col(f"first.{c}").alias(c) for c in ADDED))


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", width: int = 10, clean: bool = False) -> DataFrame:
    """All columns of ``documents`` and, for each row, ``n_words``, ``n_hit`` (words
    inside an occurrence of a window), ``items`` (sorted ids, as strings, of items with an
    occurring window) and ``spans`` (merged byte ranges to remove).

    With ``clean`` the text has its spans replaced by line breaks, again until
    none is left.  A null text has no words and stays null.  Items without an id are one
    item, the null at the end of ``items``; one with the empty id is another.  Rows keep their
    partitions: no shuffle.  Added columns replace any of the same names.

    Phrases come in blocks of BLOCK_BYTES, one pass over the documents each, written
    between passes; a single block needs no written table.
    """
    base = documents.drop(*ADDED)
    phrases = pieces(benchmark, item, item_text, width)
    blocks = int(phrases.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // BLOCK_BYTES + 1
    if blocks > 1:
        staged = scratch.stage(phrases, "phrases")
        out = _in_passes(base, staged, blocks, text, width, clean)
        scratch.discard(staged)
        return out
    sent = documents.sparkSession.sparkContext.broadcast(_block(phrases, 0, 1, width))
    at = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = bw.strings(batch.column(at))
            for lo, hi in bw.slices(whole, SHARD_BYTES):
                column = whole.slice(lo, hi - lo)
                words, hit, items = _examine(column, sent.value)
                offsets = bw.offsets_of(column)
                offsets = offsets - offsets[0]
                columns = [c.slice(lo, hi - lo) for c in batch.columns]
                if clean and hit.any():
                    texts = columns[at].to_pylist()
                    todo = {i: s for i, s in enumerate(_spans(words, hit, offsets)) if s}
                    while todo:
                        for i, s in todo.items():
                            texts[i] = _without(texts[i], s)
                        some = list(todo)
                        part = bw.strings(pa.array([texts[i] for i in some], pa.string()))
                        w, h, _ = _examine(part, sent.value)
                        o = bw.offsets_of(part)
                        todo = {some[k]: s for k, s in enumerate(_spans(w, h, o - o[0])) if s}
                    columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, *_columns(words, hit, items, offsets)], names=[*batch.schema.names, *ADDED])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields), "n_words long",
                        "n_hit long", "items array<string>", f"spans {_SPANS}"])
    return base.mapInArrow(run, schema)
