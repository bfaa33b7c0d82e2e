"""Ranked lexical search over K2-treaps (operator 12).

1. One scan counts documents with terms (N) and terms (L); these two numbers fix
   every posting's *impact* ``(10^9 tf) div (1000 tf + 12 m)``.
2. Documents are indexed in shards: a term-document grid (rows: terms by falling
   document frequency, columns: documents by ascending id) as a quadtree whose cells store the
   greatest impact inside them.  The tree is kept breadth first as child masks; ranks of the masks
   give the child positions, and a cell with one posting ends its branch.  The index is a
   written table, one row per shard, and does not depend on any query.
3. Queries come in blocks of bounded size.  The shards' dictionaries give the document
   frequencies of a block's terms (one sum per term), hence their weights.
4. In every shard the row paths descend jointly over ranges of documents: an item's bound
   for a range is the weighted sum of the maxima of its rows' cells there.  Items open their
   best ranges first, then only those whose bound reaches the k-th best score so far, which a task
   carries from shard to shard.  Paths are shared by the items of a block, as most hold the
   same frequent terms.

Scores are exact 64-bit integers; terms are told apart by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm import bytewords as bw
from lodestar.llm import scratch

SHARD_BYTES = 2 << 20       # texts of one shard, about (one longer text stands alone)
BLOCK_BYTES = 1 << 20       # item texts sent to the tasks at a time, about
STEP = 3                    # levels that paths descend between two looks at the bounds
FIRST_SPANS = 16            # ranges of a shard from which on bounds are worth a look
NO_ID = np.iinfo(np.int64).max      # sorts rows without an id last

_POP = np.array([bin(i).count("1") for i in range(16)], np.int64)
_BELOW = np.array([(1 << q) - 1 for q in range(4)], np.uint8)


def term_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(row, term hash)`` of a slice with their counts, and terms per row."""
    words = bw.scan(column, bw.ALNUM)
    hashes = words.hashes()
    order = np.lexsort((hashes, words.doc))
    h, d = hashes[order], words.doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(fresh)
    return d[at], h[at], np.diff(np.append(at, len(h))), words.counts


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit values moved to the even places."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(keep)
    return x


def _least_type(top: int):
    return np.uint16 if top < 1 << 16 else np.uint32


@dataclass
class Treap:
    """Quadtree of one shard.  ``mask``: children of each cell (bit 2 * row half + column
    half; 0: a single posting), ``peak``: greatest impact inside, ``row``/``col``:
    place of the single postings, all breadth first."""

    height: int
    mask: np.ndarray
    peak: np.ndarray
    row: np.ndarray
    col: np.ndarray

    def __post_init__(self):
        kids = _POP[self.mask].astype(np.int32)
        self.first = np.cumsum(kids, dtype=np.int32) - kids + 1
        self.single = np.cumsum(self.mask == 0, dtype=np.int32) - 1

    def dump(self) -> bytes:
        head = np.array([self.height, len(self.mask), len(self.row), self.row.dtype.itemsize, self.col.dtype.itemsize], "<i8")
        return b"".join([head.tobytes(), self.peak.astype("<u4").tobytes(), self.row.tobytes(), self.col.tobytes(),
                         self.mask.tobytes()])

    @staticmethod
    def load(data: bytes) -> Treap:
        height, cells, ends, rb, cb = np.frombuffer(data, "<i8", 5).tolist()
        peak = np.frombuffer(data, "<u4", cells, 40)
        row = np.frombuffer(data, f"<u{rb}", ends, at := 40 + 4 * cells)
        col = np.frombuffer(data, f"<u{cb}", ends, at := at + rb * ends)
        return Treap(height, np.frombuffer(data, np.uint8, cells, at + cb * ends), peak, row, col)


def build(row: np.ndarray, col: np.ndarray, impact: np.ndarray) -> Treap:
    """Treap of distinct postings ``(row, col)``, at least one."""
    height = max(int(row.max()), int(col.max())).bit_length()
    code = _spread(row) << np.uint64(1) | _spread(col)
    order = np.argsort(code, kind="stable")
    code, row, col, impact = code[order], row[order], col[order], impact[order]
    masks, peaks, ends = [], [], []
    here = np.arange(len(code))                 # postings in cells that go on
    cuts, sizes = np.zeros(1, np.int64), np.array([len(code)])
    top = np.array([impact.max()])
    for level in range(height, -1, -1):
        open_ = sizes > 1
        mask = np.zeros(len(sizes), np.uint8)
        peaks.append(top)
        masks.append(mask)
        ends.append(here[cuts[~open_]])
        if not open_.any():
            break
        here = here[np.repeat(open_, sizes)]
        key = code[here] >> np.uint64(2 * (level - 1))
        cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        child = key[cuts]
        parent = child >> np.uint64(2)
        starts = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
        mask[open_] = np.bitwise_or.reduceat((1 << (child & np.uint64(3)).astype(np.int64)).astype(np.uint8), starts)
        sizes = np.diff(np.append(cuts, len(here)))
        top = np.maximum.reduceat(impact[here], cuts)
    at = np.concatenate(ends)
    return Treap(height, np.concatenate(masks), np.concatenate(peaks).astype(np.uint32),
                 row[at].astype(_least_type(int(row.max()))), col[at].astype(_least_type(int(col.max()))))


@dataclass
class _Paths:
    """Cells on the paths of some rows at one level, by row, then range: entry j says
    that row ``row[j]`` has postings in range ``span[j]`` of ``2^level`` documents, at most
    ``peak[j]`` each, in cell ``cell[j]``.  Entries of row r are ``cut[r]:cut[r+1]``."""

    level: int
    row: np.ndarray
    span: np.ndarray
    cell: np.ndarray
    peak: np.ndarray
    cut: np.ndarray


def _paths(t: Treap, level: int, places: np.ndarray, row, span, cell) -> _Paths:
    """Entries without those whose cell holds one posting of another row."""
    ends = t.mask[cell] == 0
    ok = ~ends
    ok[ends] = t.row[t.single[cell[ends]]] == places[row[ends]]
    row, span, cell = row[ok], span[ok], cell[ok]
    cut = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(places)))))
    return _Paths(level, row, span, cell, t.peak[cell].astype(np.int64), cut)


def _open(t: Treap, p: _Paths, places: np.ndarray, wanted: np.ndarray) -> _Paths:
    """The next level of all paths inside the ranges of ``wanted``."""
    some = np.flatnonzero(wanted[p.span])
    row, span, cell, half = p.row[some], p.span[some], p.cell[some], p.level - 1
    mask = t.mask[cell]
    ends = mask == 0
    side = np.full(len(cell), -1)
    side[ends] = (t.col[t.single[cell[ends]]] >> half) & 1
    quad = (((places[row] >> half) & 1) * 2)[:, None] + np.arange(2)
    there = ((mask[:, None] >> quad.astype(np.uint8)) & 1).astype(bool) | (side[:, None] == np.arange(2))
    down = t.first[cell][:, None] + _POP[mask[:, None] & _BELOW[quad]]
    down = np.where(ends[:, None], cell[:, None], down)
    both = np.broadcast_to(row[:, None], there.shape)
    return _paths(t, half, places, both[there], (2 * span[:, None] + np.arange(2))[there], down[there])


Best = tuple[np.ndarray, np.ndarray]


class _Item:
    """Search state of one item in one shard."""

    def __init__(self, rows: np.ndarray, weights: np.ndarray, k: int, best: Best):
        self.rows, self.weights, self.k, self.best = rows, weights, k, best
        self.exact = float(weights.sum()) * 1_000_000 < 2.0 ** 53

    def sums(self, p: _Paths, alive: np.ndarray | None, spans: int) -> np.ndarray:
        """Weighted sum of the peaks of every range; 0 outside ``alive`` (of a coarser level)."""
        size = p.cut[self.rows + 1] - p.cut[self.rows]
        at = np.repeat(p.cut[self.rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
        weight = np.repeat(self.weights, size)
        span = p.span[at]
        if alive is not None:
            inside = alive[span]
            at, weight, span = at[inside], weight[inside], span[inside]
        worth = weight * p.peak[at]
        if self.exact:                      # sums below 2^53 are exact in doubles
            return np.bincount(span, worth, spans).astype(np.int64)
        total = np.zeros(spans, np.int64)
        np.add.at(total, span, worth)
        return total

    def reach(self, bound: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Ranges that may still hold one of the best; ``firsts``: their first ids."""
        if len(self.best[0]) < self.k:
            return bound > 0
        least, last = self.best[0][-1], self.best[1][-1]
        return (bound > least) | ((bound == least) & (firsts <= last))

    def take(self, score: np.ndarray, ids: np.ndarray) -> None:
        at = np.flatnonzero(self.reach(score, ids))
        score, doc = np.append(self.best[0], score[at]), np.append(self.best[1], ids[at])
        order = np.lexsort((doc, -score))[: self.k]
        self.best = score[order], doc[order]


def search(t: Treap, ids: np.ndarray, places: np.ndarray, items: list[_Item]) -> None:
    """Add the shard to the best of every item: higher scores first, then smaller ids.
    ``ids`` ascends with the columns; ``places`` are the rows that items name by position.

    The paths of all rows descend together; every STEP levels each item's bounds are summed
    over its own rows, and a range is opened only where some item still needs it.
    Each item first opens its best ranges, then what these leave within reach."""
    width = len(ids)
    firsts = lambda level: ids[np.minimum(np.arange((width - 1 >> level) + 1) << level, width - 1)]
    alone = np.zeros(len(places), np.int64)
    p = _paths(t, t.height, places, np.arange(len(places)), alone, alone)
    while p.level and (p.level % STEP or p.level and width >> p.level < FIRST_SPANS):
        p = _open(t, p, places, np.ones((width - 1 >> p.level) + 1, bool))
    start, spans = p, (width - 1 >> p.level) + 1
    bounds = [i.sums(p, None, spans) for i in items]
    if p.level == 0:
        for item, score in zip(items, bounds, strict=True):
            item.take(score, ids)
        return
    done = [np.zeros(spans, bool)] * len(items)
    for wave in (spans // 8 + 1, spans):
        p, alive = start, []
        for n, (item, bound) in enumerate(zip(items, bounds, strict=True)):
            now = item.reach(bound, firsts(p.level)) & ~done[n]
            if wave < spans:
                best = np.argsort(-bound, kind="stable")[:wave]
                now &= np.isin(np.arange(spans), best)
            done[n] = done[n] | now
            alive.append(now)
        while p.level and any(a.any() for a in alive):
            wanted = np.logical_or.reduce(alive)
            coarse = p.level
            for _ in range(STEP):
                p = _open(t, p, places, wanted)
                wanted = np.repeat(wanted, 2)
            n = (width - 1 >> p.level) + 1
            for j, item in enumerate(items):
                if alive[j].any():
                    inside = np.repeat(alive[j], 1 << coarse - p.level)[:n]
                    score = item.sums(p, inside, n)
                    if p.level == 0:
                        item.take(score, ids)
                    else:
                        alive[j] = inside & item.reach(score, firsts(p.level))
                else:
                    alive[j] = np.zeros(n, bool)


# --- index ------------------------------------------------------------------------

def impact_of(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 100 - 25 + (25 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight_of(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Index:
    """A written index: one row per shard ``ids, terms, dfs, grid`` (binary each)."""

    table: DataFrame
    n_docs: int
    n_terms: int


def _shard(ids: list, parts: list, counts: list, n_docs: int, n_terms: int) -> tuple[bytes, ...]:
    doc, term, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
    keys = np.array([NO_ID if i is None else i for i in ids], np.int64)
    order = np.argsort(keys, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    parts.clear()
    terms, row = np.unique(term, return_inverse=True)
    df = np.bincount(row, minlength=len(terms))
    by_df = np.argsort(-df, kind="stable")          # frequent terms share cells, so rare ones keep low maxima
    rank = np.empty(len(by_df), np.int64)
    rank[by_df] = np.arange(len(by_df))
    impact = impact_of(tf, np.concatenate(counts)[doc], n_docs, n_terms)
    grid = build(rank[row], place[doc], impact)
    return (keys[order].tobytes(), terms.tobytes() + rank.astype("<u4").tobytes(), df.astype("<u4").tobytes(), grid.dump())


def build_index(documents: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """Index every row of ``documents`` that has a term.  Rows stay in their partitions."""
    docs = documents.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, terms, size = 0, 0, 0
        for batch in batches:
            column = bw.strings(batch.column(0))
            for lo, hi in bw.slices(column):
                part = column.slice(lo, hi - lo)
                n = bw.scan(part, bw.ALNUM).counts
                held, terms, size = held + int((n > 0).sum()), terms + int(n.sum()), size + int(np.diff(bw.offsets_of(part)).sum())
        yield pa.RecordBatch.from_pydict({"n": [held], "l": [terms], "b": [size]})

    n_docs, n_terms, size = (int(x or 0) for x in docs.select("t").mapInArrow(count, "n long, l long, b long")
                             .agg(F.sum("n"), F.sum("l"), F.sum("b")).first())

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, counts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            made = _shard(ids, parts, counts, n_docs, n_terms)
            ids.clear(), parts.clear(), counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in made], names=["ids", "terms", "dfs", "grid"])

        for batch in batches:
            column = bw.strings(batch.column(1))
            for lo, hi in bw.slices(column):
                part = column.slice(lo, hi - lo)
                doc, term, tf, n = term_counts(part)
                if not len(doc):
                    continue
                parts.append(((doc + len(ids)).astype(np.int64), term, tf))
                counts.append(n)
                ids.extend(batch.column(0).slice(lo, hi - lo).to_pylist())
                held += int(np.diff(bw.offsets_of(part)).sum())
                if held >= SHARD_BYTES:
                    yield close()
                    held = 0
        if parts:
            yield close()

    spark = documents.sparkSession
    # Shards fill up only if partitions hold enough text; merging neighbours moves no row.
    whole = docs.coalesce(max(spark.sparkContext.defaultParallelism, size // SHARD_BYTES + 1))
    # Small row groups: readers and writers hold a few shards, not a file of them.
    where = scratch.path(spark, "k2treap")
    made = whole.mapInArrow(index, "ids binary, terms binary, dfs binary, grid binary")
    small = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
             "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false"}
    made.write.options(**small).parquet(where)
    table = spark.read.schema(made.schema).parquet(where)
    return Index(table, n_docs, n_terms)


# --- queries ----------------------------------------------------------------------

@dataclass
class Block:
    """Items of one block: ``terms`` ascending; item i has ``at[cut[i]:cut[i+1]]`` with counts."""

    number: list[int]
    terms: np.ndarray
    cut: np.ndarray
    at: np.ndarray
    count: np.ndarray


def block_of(numbers: list[int], texts: pa.Array) -> Block:
    parts = [term_counts(texts.slice(lo, hi - lo)) for lo, hi in bw.slices(texts)] or [term_counts(texts)]
    size = np.concatenate([np.bincount(d, minlength=len(n)) for d, _, _, n in parts])
    term = np.concatenate([h for _, h, _, _ in parts])
    terms, at = np.unique(term, return_inverse=True)
    return Block(numbers, terms, np.concatenate(([0], np.cumsum(size))), at, np.concatenate([c for _, _, c, _ in parts]))


def _places(terms: bytes, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each term of the block its place in the shard's dictionary and its row; -1 where absent."""
    n = memoryview(terms).nbytes // 12
    t, rank = np.frombuffer(terms, "<u8", n), np.frombuffer(terms, "<u4", n, 8 * n)
    at = np.minimum(np.searchsorted(t, block.terms), len(t) - 1)
    there = t[at] == block.terms
    return np.where(there, at, -1), np.where(there, rank[at].astype(np.int64), -1)


def _frequencies(index: Index, sent) -> dict[int, int]:
    """Document frequencies of the block's terms (at most one number per term of the block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = sent.value
        total = np.zeros(len(block.terms), np.int64)
        for batch in batches:
            for terms, dfs in zip(batch.column(0), batch.column(1), strict=True):
                at, _ = _places(terms.as_buffer(), block)
                df = np.frombuffer(dfs.as_buffer(), "<u4").astype(np.int64)
                total[at >= 0] += df[at[at >= 0]]
        had = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(had, pa.int64()), pa.array(total[had], pa.int64())], names=["p", "df"])

    got = index.table.select("terms", "dfs").mapInArrow(run, "p long, df long").groupBy("p").agg(F.sum("df").alias("df")).toArrow()
    return dict(zip(got.column("p").to_pylist(), got.column("df").to_pylist(), strict=True))


def _search_block(index: Index, block: Block, k: int, name: str) -> DataFrame:
    """Best rows of every task for the items of one block, written."""
    spark = index.table.sparkSession
    sent = spark.sparkContext.broadcast(block)
    df = _frequencies(index, sent)
    weights = np.array([weight_of(df[p], index.n_docs) if p in df else 0 for p in range(len(block.terms))], np.int64)
    heavy = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = sent.value, heavy.value
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        best = [none] * len(block.number)
        for batch in batches:
            for ids, terms, grid in zip(*batch.columns, strict=True):
                _, row = _places(terms.as_buffer(), block)
                held = np.flatnonzero((row >= 0) & (weights > 0))
                if not len(held):
                    continue
                position = np.full(len(row), -1)
                position[held] = np.arange(len(held))
                asking = []
                for i in range(len(best)):
                    at = block.at[block.cut[i]: block.cut[i + 1]]
                    here = position[at] >= 0
                    if here.any():
                        count = block.count[block.cut[i]: block.cut[i + 1]][here]
                        asking.append((i, _Item(position[at][here], weights[at][here] * count, k, best[i])))
                search(Treap.load(grid.as_buffer()), np.frombuffer(ids.as_buffer(), np.int64), row[held], [x for _, x in asking])
                for i, item in asking:
                    best[i] = item.best
        size = [len(s) for s, _ in best]
        score, doc = (np.concatenate([b[x] for b in best]) if best else none[0] for x in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(block.number, np.int64), size), pa.int64()),
             pa.array(doc, pa.int64(), mask=doc == NO_ID), pa.array(score, pa.int64())], names=["i", "doc_id", "score"])

    found = scratch.stage(index.table.select("ids", "terms", "grid").mapInArrow(run, "i long, doc_id long, score long"), name)
    heavy.destroy()
    sent.destroy()
    return found


def rank(index: Index, items: DataFrame, k: int = 20, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest score above 0
    for every item, equal scores by ascending doc_id (rows without an id last).

    Rows of ``items`` with equal id and text are one item; other texts under the same id, or rows
    without an id, are ranked apart.  Items with null or empty texts or without known terms have no
    rows.  Repeated documents are ranked as often as they occur.  Other columns are ignored.
    """
    spark = items.sparkSession
    asked = scratch.stage(items.select(F.col(item).alias("item_id"), F.col(text).cast("string").alias("t")).where("t is not null")
                          .distinct().withColumn("i", F.monotonically_increasing_id()), "items")
    size = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = int(size) // BLOCK_BYTES + 1
    found = []
    for b in range(blocks):
        got = asked.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).select("i", "t").toArrow()
        if got.num_rows:
            found.append(_search_block(index, block_of(got.column("i").to_pylist(), bw.strings(got.column("t"))), k, "ranked"))
    if not found:
        return asked.selectExpr("item_id", "0 as rank", "cast(null as long) as doc_id", "0L as score").where("false")
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    order = Window.partitionBy("i").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = together.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(asked.select("i", "item_id"), "i").select("item_id", "rank", "doc_id", "score")
