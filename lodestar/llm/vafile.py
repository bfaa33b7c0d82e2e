"""Exact top-k inner products with a vector-approximation file (operator 9).

Vectors are integers.  The approximation of a vector is the grid cell that each
component falls in (cells of 2^shift values).  With the cells' lower corners L and
w = 2^shift - 1, every inner product lies in [q.L - w*neg(q), q.L + w*pos(q)], where
pos and neg add up the positive and negative components of q.  A task scans
the cells of its vectors for these bounds, then reads exact vectors in the
order of their bounds until the k-th result is certain.

Queries come in blocks of bounded bytes, each sent to all tasks for one
scan of the vectors; a task returns k rows per query at most, and the best of them
are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm import scratch

QUERY_BYTES = 8 << 20       # of a block of queries
TILE = 256                  # queries scanned together
CHUNK = 4096                # vectors scanned together


def parse(ids, vectors, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """``dimension -> (ids, integer vectors)``; vectors that are null, empty or hold a null
    or non-finite component, and rows without an id, take no part."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    size = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ok = (size > 0) & ids.is_valid().to_numpy(zero_copy_only=False)
    key = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = {}
    for d in np.unique(size[ok]):
        rows = np.flatnonzero(ok & (size == d))
        flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
        x = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, int(d))
        good = np.isfinite(x).all(axis=1)
        if good.any():
            out[int(d)] = key[rows[good]], np.floor(scale * x[good])
    return out


def _place(first: np.ndarray) -> np.ndarray:
    """Number of each row within its run; ``first`` marks where runs begin."""
    head = np.flatnonzero(first)
    return np.arange(len(first)) - np.repeat(head, np.diff(np.append(head, len(first))))


def merge(q, ids, scores, k: int):
    """The k best of each query: higher score first, ties to the smaller id; copies of a row stay."""
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    keep = _place(np.concatenate(([True], q[1:] != q[:-1]))[: len(q)]) < k
    return q[keep], ids[keep], scores[keep]


def scan(queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, shift: int,
         best: tuple[np.ndarray, np.ndarray, np.ndarray], stats: dict | None = None):
    """``best`` (query row, id, score; at most k per query) after these vectors."""
    # Of the copies of a row only k can matter, and of equal vectors the 2 k first of those (k may be the query's own).
    order = np.lexsort((ids, *vectors.T))
    differ = np.concatenate(([True], (vectors[order][1:] != vectors[order][:-1]).any(axis=1)))
    order = order[_place(differ | np.concatenate(([True], ids[order][1:] != ids[order][:-1]))) < k]
    differ = np.concatenate(([True], (vectors[order][1:] != vectors[order][:-1]).any(axis=1)))
    order = np.sort(order[_place(differ) < 2 * k])
    ids, vectors = ids[order], vectors[order]

    width = float((1 << shift) - 1)
    cells = np.floor_divide(vectors, 1 << shift) * (1 << shift)         # lower corners
    for t in range(0, len(queries), TILE):
        q = queries[t: t + TILE]
        approx = q @ cells.T
        own = query_ids[t: t + TILE, None] == ids[None, :]
        approx[own] = -np.inf
        above = width * np.maximum(q, 0).sum(axis=1)
        below = width * np.minimum(q, 0).sum(axis=1)
        mine = (best[0] >= t) & (best[0] < t + len(q))
        have = (best[0][mine], best[1][mine], best[2][mine])
        floor_ = np.full(len(q), -np.inf)       # a score that k candidates surely reach
        if approx.shape[1] >= k:
            floor_ = np.partition(approx, -k, axis=1)[:, -k] + below
        row, col = np.nonzero((approx + above[:, None] >= floor_[:, None]) & np.isfinite(approx))
        bound = approx[row, col] + above[row]
        order = np.lexsort((ids[col], -bound, row))
        row, col, bound = row[order], col[order], bound[order]
        first = np.searchsorted(row, np.arange(len(q)))
        last = np.searchsorted(row, np.arange(len(q)), "right")
        at = first.copy()
        while True:
            # k-th result so far; a query is certain once its next bound is lower.
            have = merge(*have, k)
            count = np.bincount(have[0] - t, minlength=len(q))
            kth = np.full(len(q), -np.inf)
            kth_id = np.full(len(q), np.iinfo(np.int64).max)
            full = np.flatnonzero(count >= k)
            if len(full):
                end = np.searchsorted(have[0], full + t, "right") - 1
                kth[full], kth_id[full] = have[2][end], have[1][end]
            open_ = np.flatnonzero(at < last)
            b, i = bound[at[open_]], ids[col[at[open_]]]
            open_ = open_[(b > kth[open_]) | ((b == kth[open_]) & (i < kth_id[open_]))]
            if not len(open_):
                break
            stop = np.minimum(at[open_] + 2 * k, last[open_])
            n = stop - at[open_]
            pick = np.repeat(at[open_] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum()))
            r, c = row[pick], col[pick]
            exact = np.einsum("ij,ij->i", q[r], vectors[c])
            if stats is not None:
                stats["read"] = stats.get("read", 0) + len(pick)
            have = (np.concatenate([have[0], r + t]), np.concatenate([have[1], ids[c]]), np.concatenate([have[2], exact]))
            at[open_] = stop
        best = tuple(np.concatenate([a[~mine], b]) for a, b in zip(best, have, strict=True))
    return best


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
          scale: float = 256.0, shift: int = 2) -> DataFrame:
    """``query_id long, rank int, vec_id long, score long``: for each row of ``queries`` the k
    rows of ``vectors`` (but those with the query's own id) with the highest inner
    product of components floor(scale * x); all if fewer; ties to the smaller id.

    Vectors that are null or empty or hold null or non-finite components, and rows
    without an id, take no part; only vectors of equal dimension are compared.  Every row
    counts, as in SQL: copies of a row are as many neighbours, and rows of ``queries`` with
    one id ask together, each neighbour coming once for every row that asked.  Scores are
    exact below 2^53.
    """
    spark = vectors.sparkSession
    pick = lambda df: df.select(F.col(id_column).cast("long").alias("i"), F.col(vector).cast("array<double>").alias("v"))
    asked = pick(queries).where("i is not null and size(v) > 0").groupBy("i", "v").agg(F.count(F.lit(1)).alias("copies"))
    n, widest = asked.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = max(1, -(-n * (widest or 1) * 8 // QUERY_BYTES))

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    found = None
    for b in range(blocks):
        got = asked.where(F.pmod(F.xxhash64("i", "v"), F.lit(blocks)) == b).toArrow()
        query_ids, copies = (got.column(c).to_numpy().astype(np.int64) for c in ("i", "copies"))
        rows = parse(pa.array(np.arange(len(got))), got.column("v"), scale)
        sent = spark.sparkContext.broadcast({d: (query_ids[r], v, np.minimum(copies[r], k)) for d, (r, v) in rows.items()})

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            best = {d: (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) for d in block}
            for batch in batches:
                for d, (ids, v) in parse(batch.column(0), batch.column(1), scale).items():
                    if d in block:
                        for c in range(0, len(ids), CHUNK):
                            best[d] = scan(block[d][1], block[d][0], ids[c: c + CHUNK], v[c: c + CHUNK], k, shift, best[d])
            for d, (row, ids, score) in best.items():
                times = block[d][2][row]
                row, ids, score = merge(*(np.repeat(a, times) for a in (row, ids, score)), k)
                yield pa.RecordBatch.from_arrays([pa.array(block[d][0][row]), pa.array(ids), pa.array(score.astype(np.int64))],
                                                 names=["query_id", "vec_id", "score"])

        part = best(pick(vectors).mapInArrow(run, "query_id long, vec_id long, score long"))
        part = part if blocks == 1 else scratch.stage(part, "topk")     # one block of queries at a time
        found = part if found is None else found.unionByName(part)
    return found if blocks == 1 else best(found.drop("rank"))           # rows of one query id may be in several blocks
