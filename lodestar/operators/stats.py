"""Statistics over columns and sparse features.

Regression by gradient descent is driven by sufficient statistics: one
aggregate pass computes n, X'X, X'y and y'y, after which every iteration (its
gradient and its loss) is arithmetic on those few numbers.  The data are read
once instead of once per iteration, and nothing but the statistics reaches the
driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions.numeric import significant


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- A13 / M7

def ols_fit(df: DataFrame, x, y) -> DataFrame:
    """M7: closed-form simple least squares (numerically stable built-ins)."""
    xs, ys = _c(x).cast("double"), _c(y).cast("double")
    return df.agg(F.regr_count(ys, xs).alias("n"), F.regr_slope(ys, xs).alias("slope"),
                  F.regr_intercept(ys, xs).alias("intercept"), F.regr_r2(ys, xs).alias("r2"))


# ---------------------------------------------------------------- M8 / M9

@dataclass
class GramStats:
    """n, X'X, X'y, y'y for a design matrix with columns ``names``."""
    names: list[str]
    n: float
    xtx: np.ndarray
    xty: np.ndarray
    yty: float


def gram_stats(df: DataFrame, features: list, y, names: list[str] | None = None) -> GramStats:
    """One aggregate pass over ``df`` (partial sums per task, one row out)."""
    xs = [(_c(f) if not isinstance(f, (int, float)) else F.lit(float(f))).cast("double") for f in features]
    ys = _c(y).cast("double")
    d = len(xs)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(ys * ys).alias("yty")]
    for i in range(d):
        aggs.append(F.sum(xs[i] * ys).alias(f"xy{i}"))
        for j in range(i, d):
            aggs.append(F.sum(xs[i] * xs[j]).alias(f"xx{i}_{j}"))
    row = df.agg(*aggs).first()
    xtx = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            xtx[i, j] = xtx[j, i] = row[f"xx{i}_{j}"] or 0.0
    xty = np.array([row[f"xy{i}"] or 0.0 for i in range(d)])
    return GramStats(names or [f"x{i}" for i in range(d)], float(row["n"]), xtx, xty, float(row["yty"] or 0.0))


def gd_trace(stats: GramStats, w0: float, lr: float, iters: int, scale_by_n: bool,
             step_rule: str = "fixed", step_delta: float = 0.0) -> list[tuple]:
    """Gradient descent on least squares from sufficient statistics.

    Per iteration: loss = sum e^2 at the current weights (reported before the
    update), gradient = X'X w - X'y (times 2/n when ``scale_by_n``), then
    ``w -= lr * gradient``.  ``step_rule='additive'`` adds ``step_delta`` to
    the rate when the loss fell and subtracts it otherwise (M9).
    Returns ``(iteration, loss, lr_used, w...)`` rows.
    """
    w = np.full(len(stats.xty), float(w0))
    out, prev = [], None
    with np.errstate(over="ignore", invalid="ignore"):   # a too-large rate diverges to inf/nan, as in SQL
        return _gd_loop(stats, w, lr, iters, scale_by_n, step_rule, step_delta, out, prev)


def _gd_loop(stats, w, lr, iters, scale_by_n, step_rule, step_delta, out, prev):
    for it in range(iters):
        loss = stats.yty - 2.0 * w @ stats.xty + w @ stats.xtx @ w
        grad = stats.xtx @ w - stats.xty
        if scale_by_n:
            grad = grad * (2.0 / stats.n)
        used = lr
        w = w - lr * grad
        if step_rule == "additive":
            lr = lr + step_delta if (prev is None or loss < prev) else lr - step_delta
        prev = loss
        out.append((it, float(loss), float(used), *[float(v) for v in w]))
    return out


def trace_frame(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    cols = ["iteration", "loss", "lr"] + names
    schema = ", ".join([f"{cols[0]} int"] + [f"{c} double" for c in cols[1:]])
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------- J9

def gram_matrix(df: DataFrame, vec_col: str) -> DataFrame:
    """(i, j, sum x_i x_j) for i <= j over array rows (null vectors and
    null components count as zeros).

    Each task adds up one product X'X per Arrow batch and hands on its d x d
    sums once (d is the vector dimension), which are then added by (i, j)."""
    def partial(batches):
        total = np.zeros((0, 0))
        for batch in batches:
            rows = batch.column(0)
            sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = np.nan_to_num(rows.flatten().cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False))
            d = int(sizes.max(initial=0))
            x = np.zeros((len(sizes), d))
            x[np.arange(d)[None, :] < sizes[:, None]] = flat
            if d > len(total):
                total = np.pad(total, (0, d - len(total)))
            total[:d, :d] += x.T @ x
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "g"])

    return (df.select(vec_col).mapInArrow(partial, "i long, j long, g double")
            .groupBy("i", "j").agg(F.sum("g").alias("g")))


HEAD = 2048                 # positions whose products a task keeps as one dense matrix (32 MB)
HEAD_ROWS = 256             # rows of one dense product
PAIR_LIMIT = 1 << 20        # products outside the head that a task works on at once
TILE_CELLS = 1 << 25        # cells outside the head that a task keeps as one dense matrix (256 MB)


def _tail_pairs(row: np.ndarray, pos: np.ndarray, x: np.ndarray, tail):
    """Products ``(i, j, x_i x_j)``, i <= j, of entries of one row with j among the entries ``tail`` (a mask, or
    the first position outside the head), in chunks of about PAIR_LIMIT; entries ascend by (row, position)."""
    first = np.searchsorted(row, row)                   # first entry of the own row
    at = np.flatnonzero(pos >= tail if np.isscalar(tail) else tail)
    many = at - first[at] + 1                           # partners up to and with itself
    ends = np.cumsum(many)
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - many[lo] + PAIR_LIMIT, "right")))
        some, n = at[lo:hi], many[lo:hi]
        right = np.repeat(some, n)
        left = np.repeat(first[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield pos[left], pos[right], x[left] * x[right]
        lo = hi


def gram_blocks(rows: DataFrame, size: int, head: int = HEAD, tile_cells: int = TILE_CELLS) -> DataFrame:
    """J9 for sparse rows over ``size`` positions: ``(i, j, g)`` with i <= j and
    g = sum x_i x_j, for every pair of positions that some row holds together.

    ``rows`` has list columns ``pos`` (ascending, distinct) and ``x``; null or empty
    lists and zeros count for nothing.  Positions below ``head`` (the frequent ones, when
    positions go by frequency) form one dense block: a task adds its rows' products up
    in a single head x head matrix and hands it on once.  The columns outside are dealt in turn over tiles
    of ``tile_cells`` cells; a row goes to every tile that has one of its columns, so its entries are
    shuffled once a tile and never its products, and a tile is added up in one dense matrix."""
    from lodestar.operators.linear import packed, sparse_slices, unpacked
    head = min(head, size)
    width = max(1, tile_cells // size)          # columns of a tile
    tiles = -(-(size - head) // width)

    def cells(i, j, g):
        return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(g, pa.float64())], names=["i", "j", "g"])

    def entries(batches):
        for batch in batches:
            for lo, hi, row, pos, x in sparse_slices(batch):
                used = x != 0
                yield hi - lo, row[used], pos[used], x[used]

    def first(batches):
        dense, met = np.zeros((head, head)), np.zeros((head, head), bool)
        for n, row, pos, x in entries(unpacked(batches)):
            for a in range(0, n, HEAD_ROWS):
                s = slice(*np.searchsorted(row, [a, a + HEAD_ROWS]))
                low = pos[s] < head
                block = np.zeros((min(HEAD_ROWS, n - a), head))
                block[row[s][low] - a, pos[s][low]] = x[s][low]
                dense += block.T @ block
                there = (block != 0).astype(np.float32)
                met |= there.T @ there > 0          # a cell stays though its sum may be zero
        i, j = np.nonzero(np.triu(met))
        for k in range(0, len(i), PAIR_LIMIT):
            part = slice(k, k + PAIR_LIMIT)
            yield cells(i[part], j[part], dense[i[part], j[part]])

    def deal(batches):
        for n, row, pos, x in entries(unpacked(batches)):
            for t in range(tiles):
                mine = np.flatnonzero((pos >= head) & ((pos - head) % tiles == t))
                if not len(mine):
                    continue
                # Of every row with a column of the tile, its entries up to the last such column.
                last = np.full(n, -1)
                last[row[mine]] = mine
                kept = np.flatnonzero(np.arange(len(row)) <= last[row])
                r = row[kept]
                starts = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
                ends = pa.array(np.append(starts, len(r)), pa.int32())
                batch = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(pos[kept], pa.int32())),
                                                    pa.ListArray.from_arrays(ends, pa.array(x[kept]))], names=["pos", "x"])
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, batch.schema) as stream:
                    stream.write_batch(batch)
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["tile", "block"])

    def rest(batches):
        found: dict = {}
        for batch in batches:
            for t, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if t not in found:
                    found[t] = np.zeros(size * width), np.zeros(size * width, bool)
                total, met = found[t]
                for _, row, pos, x in entries(pa.ipc.open_stream(block.as_buffer())):
                    for i, j, g in _tail_pairs(row, pos, x, (pos >= head) & ((pos - head) % tiles == t)):
                        at = i * width + (j - head) // tiles
                        np.add.at(total, at, g)
                        met[at] = True
        for t, (total, met) in found.items():
            at = np.flatnonzero(met)
            for k in range(0, len(at), PAIR_LIMIT):
                part = at[k: k + PAIR_LIMIT]
                yield cells(part // width, head + part % width * tiles + t, total[part])

    blocks = packed(rows, "pos", "x").select("block")
    schema = "i int, j int, g double"
    dense = blocks.mapInArrow(first, schema).groupBy("i", "j").agg(F.sum("g").alias("g"))
    if not tiles:
        return dense
    dealt = blocks.mapInArrow(deal, "tile int, block binary").repartitionById(tiles, "tile")
    return dense.unionByName(dealt.mapInArrow(rest, schema))


def gram_rows(cells: DataFrame) -> DataFrame:
    """Report of ``gram_blocks``: per position i of the upper triangle its number of cells, diagonal, sum
    and sum weighted by position."""
    return cells.groupBy("i").agg(
        F.count(F.lit(1)).alias("n_cells"), F.coalesce(F.sum(F.when(F.col("i") == F.col("j"), F.col("g"))), F.lit(0.0)).alias("diagonal"),
        F.sum("g").alias("total"), F.sum(F.col("g") * (F.col("j") + 1)).alias("weighted"))


# ---------------------------------------------------------------- M9, exact

@dataclass
class ExactFit:
    """Least squares from centred moments: intercept and coefficients by name (0 for a
    dependent column), the number of independent columns, the condition number of the
    correlation matrix of these, and R^2."""
    names: list[str]
    intercept: float
    coefficients: np.ndarray
    rank: int
    condition: float
    r2: float
    n: int


def centred_moments(df: DataFrame, features: list[str], y: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and centred second moments (co-moment sums) of ``features`` and ``y``, in one
    pass: Spark merges centred partial moments, so nothing cancels for columns far from zero."""
    columns = [F.col(c).cast("double") for c in (*features, y)]
    whole = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*features, y)))
    d = len(columns)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    row = whole.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
                    *[F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    n = int(row["n"])
    moments = np.zeros((d, d))
    for i, j in pairs:
        moments[i, j] = moments[j, i] = (row[f"c{i}_{j}"] or 0.0) * n
    return n, np.array([row[f"m{i}"] if n else 0.0 for i in range(d)]), moments


def pivoted_cholesky(a: np.ndarray, tol: float = 1e-10) -> tuple[np.ndarray, list[int]]:
    """Lower factor L and pivot order p with a[p][:, p] = L L' up to the rank, at which the
    largest remaining diagonal falls to ``tol`` of the largest of all."""
    a, n = a.copy(), len(a)
    order, l = list(range(n)), np.zeros((n, n))
    top = max(a.diagonal(), default=0.0)
    for k in range(n):
        best = k + int(np.argmax(a.diagonal()[k:]))
        if a[best, best] <= tol * top or a[best, best] <= 0:
            return l[:, :k], order
        for m in (a, a.T, l):
            m[[k, best]] = m[[best, k]]
        order[k], order[best] = order[best], order[k]
        l[k, k] = np.sqrt(a[k, k])
        l[k + 1:, k] = a[k + 1:, k] / l[k, k]
        a[k + 1:, k + 1:] -= np.outer(l[k + 1:, k], l[k + 1:, k])
    return l, order


def exact_regression(df: DataFrame, features: list[str], y: str) -> ExactFit:
    """M9's exact alternative: least squares with an intercept by a pivoted Cholesky
    factorisation of the correlation matrix.  Columns that depend on earlier pivots (or are
    constant) get the coefficient 0; rows with a null are left out."""
    n, mean, moments = centred_moments(df, features, y)
    d = len(features)
    scale = np.sqrt(moments.diagonal())
    safe = np.where(scale > 0, scale, 1.0)
    corr = moments / np.outer(safe, safe)
    l, order = pivoted_cholesky(corr[:d, :d])
    rank = l.shape[1]
    used = order[:rank]
    beta = np.zeros(d)
    if rank:
        z = np.linalg.solve(l[:rank], corr[used, d])
        beta[used] = np.linalg.solve(l[:rank].T, z) * safe[d] / safe[used]
    condition = float(np.linalg.cond(corr[np.ix_(used, used)])) if rank else 1.0
    fitted = float(beta @ moments[:d, d])
    return ExactFit(list(features), float(mean[d] - beta @ mean[:d]), beta, rank, condition,
                    fitted / moments[d, d] if moments[d, d] > 0 else 0.0, n)


# ---------------------------------------------------------------- A14-A16, T6, T11, M17

def column_moments(features: DataFrame, n_rows: Column,
                   pos: str = "pos", val: str = "tf") -> DataFrame:
    """Mean and population variance of every position over ``n_rows``
    rows, where absent (doc, pos) entries are zeros.  Two passes: the mean
    (<= size rows, broadcast) and the centred sum
    ``(sum_nz (x - mu)^2 + (N - nnz) mu^2) / N``."""
    n = n_rows.cast("double")
    means = (features.groupBy(pos).agg(F.sum(val).alias("s"), F.count(F.lit(1)).alias("nnz"))
             .select(pos, "nnz", (F.col("s") / n).alias("mean")))
    centred = (features.join(F.broadcast(means), pos)
               .groupBy(pos, "nnz", "mean")
               .agg(F.sum((F.col(val) - F.col("mean")) ** 2).alias("ss")))
    return centred.select(pos, "nnz", "mean",
                          ((F.col("ss") + (n - F.col("nnz")) * F.col("mean") ** 2) / n).alias("variance"))


def top_variance(moments: DataFrame, m: int, key_digits: int = 10) -> DataFrame:
    """The m positions with the largest variance (equal to
    ``key_digits`` significant digits -> smaller position first), with rank
    and ln(variance).  The rank window sees at most m rows."""
    ranked = moments.withColumn("_key", significant("variance", key_digits))
    top = ranked.orderBy(F.desc("_key"), "pos").limit(m)
    w = Window.orderBy(F.desc("_key"), "pos")
    return top.select(F.row_number().over(w).alias("rank"), "pos", "mean", "variance",
                      F.ln("variance").alias("log_variance"))


def select_positions(features: DataFrame, selected: DataFrame, pos: str = "pos", val: str = "tf") -> DataFrame:
    """Keep only the selected positions (fit on train, apply anywhere).
    Entries elsewhere become nulls instead of going, so a document without any
    selected position stays as an all-zero row."""
    chosen = selected.select(F.col(pos).alias("_chosen"))
    hit = features.join(F.broadcast(chosen), F.col(pos) == F.col("_chosen"), "left")
    return hit.select(*[c for c in features.columns if c not in (pos, val)], F.col("_chosen").alias(pos),
                      F.when(F.col("_chosen").isNotNull(), F.col(val)).alias(val))


def positive_count(df: DataFrame, label: str = "label") -> DataFrame:
    """Number of positive labels and rows."""
    return df.agg(F.sum(F.col(label).cast("long")).alias("positives"), F.count(F.lit(1)).alias("rows"))
