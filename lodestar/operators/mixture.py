"""Multinomial mixture over documents.

Documents are rows ``(doc_id, label, pos[], x[])``.  Fitted parameters stay a table,
one row ``(cls, log_pi, log_mu[])`` per class; scoring takes the classes in
blocks of bounded bytes, works in place with numpy on slices of Arrow batches
and never shuffles documents.  A Gibbs iteration draws each document's
class by inverse CDF from a seeded hash of (seed, iteration, doc_id); every task
hands on one dense row of sums per class, which are added in a tree of tasks.  Its
classes are a parameter, so its C x V model may stand on the driver, where the
Dirichlet draws happen.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators import linear as LN
from lodestar.operators.common import global_rank
from lodestar.operators.linear import TREE, sparse_slices, stable
from lodestar.session import bound_batches

BLOCK_BYTES = 8 << 20       # class parameters sent to the tasks at a time
TASK_ENTRIES = 100_000_000  # entries of the documents that a task of the sampler passes over (about 400 MB packed)
BLOCK_ENTRIES = 1 << 17     # entries in a packed block
CELLS = 1 << 16             # class parameters that are laid out at a time to be multiplied (a core's cache)
PRODUCT = 1 << 13           # those of one product, few enough for BLAS to take one thread


def class_index(labels: DataFrame, label: str = "label") -> DataFrame:
    """Distinct labels numbered 0.. in alphabetical order, without a
    single-partition window."""
    return global_rank(labels.select(label).distinct(), [F.asc(label)], "cls")


def _log_scores(sizes: np.ndarray, pos: np.ndarray, x: np.ndarray, log_pi: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Log scores (rows, C) of rows with so many entries, one after the other in ``pos`` and ``x``; ``words`` is
    log mu as (V, C), so an entry needs one run of C numbers.  The runs are laid out CELLS numbers at a time and
    multiplied row by row (a long row in parts), so the memory does not follow entries x classes."""
    if len(pos) and (pos.min() < 0 or pos.max() >= len(words)):
        raise IndexError(f"position outside of 0..{len(words) - 1}")
    classes, ends = words.shape[1], np.cumsum(sizes)
    piece = max(1, PRODUCT // classes)
    parts = np.maximum(1, -(-sizes // piece))           # of each row
    at = np.cumsum(parts) - parts
    row = np.repeat(np.arange(len(sizes)), parts)
    first = (ends - sizes)[row] + piece * (np.arange(len(row)) - at[row])
    last = np.minimum(first + piece, ends[row])
    out, laid = np.empty((len(row), classes)), np.empty((max(1, CELLS // classes), classes))
    lo = 0
    while lo < len(row):
        a = first[lo]
        hi = max(lo + 1, int(np.searchsorted(last, a + len(laid), "right")))
        some, weights = laid[:last[hi - 1] - a], x[a:last[hi - 1]]
        words.take(pos[a:last[hi - 1]], axis=0, out=some, mode="clip")
        for k, i, j in zip(range(lo, hi), (first[lo:hi] - a).tolist(), (last[lo:hi] - a).tolist(), strict=True):
            np.dot(weights[i:j], some[i:j], out=out[k])
        lo = hi
    lp = out if len(row) == len(sizes) else np.add.reduceat(out, at, axis=0)
    lp += log_pi
    return lp


def _normalised(lp: np.ndarray) -> np.ndarray:
    p = np.exp(lp - lp.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def posterior(rows: DataFrame, log_pi: np.ndarray, log_mu: np.ndarray, keep: list[str]) -> DataFrame:
    """M24 for parameters at hand: ``keep`` columns and ``post``, the posterior (C,) of log
    pi_c + sum_w x_w log mu_cw (log space, maximum subtracted), with numpy on Arrow
    batches; the parameters are broadcast once."""
    return _scored(rows.select(*_with_entries(keep)), np.asarray(log_pi, float), np.ascontiguousarray(log_mu, float), keep, True)[0]


def _with_entries(keep: list[str]) -> list[str]:
    return [*keep, *(c for c in ("pos", "x") if c not in keep)]


def _scored(rows: DataFrame, log_pi: np.ndarray, log_mu: np.ndarray, keep: list[str], last: bool):
    """One block of classes: their log scores behind those of the blocks before (column
    ``post``, if it is there); the last block makes posteriors of all."""
    params = rows.sparkSession.sparkContext.broadcast((log_pi, np.ascontiguousarray(log_mu.T)))
    more = [] if last else _with_entries(keep)[len(keep):]
    before = "post" in rows.columns
    schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (*keep, *more)] + ["post array<double>"])

    def score(batches):
        lpi, words = params.value
        for batch in batches:
            for lo, hi, row, pos, x in sparse_slices(batch):
                lp = _log_scores(np.bincount(row, minlength=hi - lo), pos, x, lpi, words)
                part = batch.slice(lo, hi - lo)
                if before:
                    old = part.column(part.schema.get_field_index("post")).flatten().to_numpy(zero_copy_only=False)
                    lp = np.hstack([old.reshape(hi - lo, -1), lp])
                lp = _normalised(lp) if last else lp
                out = pa.ListArray.from_arrays(pa.array(np.arange(len(lp) + 1) * lp.shape[1], pa.int32()), pa.array(lp.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in (*keep, *more)), out],
                                                 names=[*keep, *more, "post"])

    return rows.mapInArrow(score, schema), params


def posterior_by_blocks(rows: DataFrame, params: DataFrame, size: int, keep: list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """M24 for a table of parameters ``(cls, log_pi, log_mu[size])``, classes numbered from 0:
    as ``posterior``, but the classes come to the tasks in blocks of ``block_bytes``, and the
    driver holds one block at a time.  Between blocks the scores so far are checkpointed."""
    params = params.select("cls", "log_pi", "log_mu").checkpoint()
    classes = params.count()
    step = max(1, block_bytes // (8 * size))
    state = rows.select(*_with_entries(keep))
    for lo in range(0, classes, step):
        block = params.where((F.col("cls") >= lo) & (F.col("cls") < lo + step)).toArrow().sort_by("cls")
        log_pi = block.column("log_pi").to_numpy()
        log_mu = block.column("log_mu").combine_chunks().flatten().to_numpy().reshape(len(log_pi), size)
        last = lo + step >= classes
        state, sent = _scored(state, log_pi, log_mu, keep, last)
        if not last:
            state = state.checkpoint()
            sent.destroy()
    return state if classes else rows.select(*keep, F.array().cast("array<double>").alias("post"))


def hash_uniform(seed: int, iteration: int, key: str) -> Column:
    """A uniform in [0, 1): the first 52 bits of md5("seed:iteration:key") (any engine has md5)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{iteration}:"), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def categorical_draw(post: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Inverse CDF: the number of cumulative probabilities <= u (clamped)."""
    return np.minimum((np.cumsum(post, axis=1) <= u[:, None]).sum(axis=1), post.shape[1] - 1)


def validate_params(log_pi: DataFrame, log_mu: DataFrame, size: int, tol: float = 1e-3) -> DataFrame:
    """Per class ``sum(mu)`` and shape checks plus ``sum(pi)``; ``ok``
    is false when a vector is not a probability vector within ``tol``."""
    pi_sum = log_pi.select(F.sum(F.exp("log_pi"))).scalar()
    per = log_mu.select("cls", F.size("log_mu").alias("n_pos"),
                        F.aggregate(F.transform("log_mu", lambda v: F.exp(v)), F.lit(0.0),
                                    lambda a, b: a + b).alias("mu_sum"))
    return per.select("cls", "n_pos", "mu_sum", pi_sum.alias("pi_sum"),
                      ((F.abs(F.col("mu_sum") - 1) <= tol) & (F.abs(pi_sum - 1) <= tol)
                       & (F.col("n_pos") == size)).alias("ok"))


# ------------------------------------------------------------------ fitting

def mle_params(rows: DataFrame, cls_col: str, size: int, beta: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Class shares and smoothed class-word distributions from labelled rows:
    pi_c = n_c / N, mu_cw = (beta + S_cw) / (beta V + sum_w S_cw) where S are
    summed feature values.  Each class collects at most V (pos, S) pairs."""
    counts = rows.groupBy(cls_col).agg(F.count(F.lit(1)).alias("n"))
    total = rows.select(F.count(F.lit(1))).scalar()
    log_pi = counts.select(F.col(cls_col).alias("cls"), F.ln(F.col("n") / total).alias("log_pi"))
    sums = (rows.select(cls_col, F.explode(F.arrays_zip("pos", "x")).alias("e"))
            .groupBy(cls_col, F.col("e.pos").alias("pos")).agg(F.sum("e.x").alias("s")))
    kind = rows.schema[cls_col].dataType.simpleString()

    def smooth(batches):
        for pdf in batches:
            out = []
            for pos, s in zip(pdf["pos"], pdf["s"]):
                full = np.zeros(size)
                full[np.asarray(pos, dtype=np.int64)] = s
                out.append(np.log((beta + full) / (beta * size + full.sum())))
            yield pd.DataFrame({"cls": pdf["cls"], "log_mu": out})

    per_cls = sums.groupBy(F.col(cls_col).alias("cls")).agg(F.collect_list("pos").alias("pos"), F.collect_list("s").alias("s"))
    return log_pi, per_cls.mapInPandas(smooth, f"cls {kind}, log_mu array<double>")


def require_valid(checks: DataFrame) -> DataFrame:
    """M25's raising form: the rows of ``validate_params``, failing the job with the offending
    class as soon as one of them is not ok."""
    wrong = F.concat(F.lit("not a probability vector: class "), F.col("cls").cast("string"),
                     F.lit(" with sum "), F.col("mu_sum").cast("string"), F.lit(" over "), F.col("n_pos").cast("string"), F.lit(" positions"))
    return checks.where(F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(wrong).cast("boolean")))


@dataclass
class GibbsResult:
    pi: np.ndarray
    mu: np.ndarray
    counts: list
    assigned: DataFrame
    data: DataFrame         # cached blocks behind ``assigned``: unpersist when done


def packed(rows: DataFrame) -> DataFrame:
    """``block binary``: the rows' doc_id as text, label (where they have one), pos and x as Arrow streams of bounded size
    for many passes.  Positions have the least unsigned type, and x is numbers of the block's distinct values, so
    an entry of a term frequency takes 4 bytes instead of 12; nothing is rounded."""
    extra = [c for c in rows.columns if c == "label"]

    def least(a):
        return pa.array(a.astype(np.min_scalar_type(int(a.max(initial=0)))))

    def pack(batches):
        for batch in batches:
            for lo, hi, row, pos, x in sparse_slices(batch, BLOCK_ENTRIES):
                ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=hi - lo)))), pa.int32())
                values, code = np.unique(x, return_inverse=True)
                lists = (least(pos), pa.DictionaryArray.from_arrays(least(code), pa.array(values)))
                part = pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[:-2], *(pa.ListArray.from_arrays(ends, v) for v in lists)],
                                                  names=batch.schema.names)
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, part.schema) as stream:
                    stream.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["block"])

    return rows.select(F.col("doc_id").cast("string").alias("doc_id"), *extra, "pos", "x").mapInArrow(pack, "block binary")


def _entries(part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of each row, positions and values of an unpacked block."""
    at, xs = part.column(part.num_columns - 2), part.column(part.num_columns - 1).flatten()
    return (at.value_lengths().to_numpy().astype(np.int64), at.flatten().to_numpy().astype(np.int64),
            xs.dictionary.to_numpy().take(xs.indices.to_numpy()))


def uniforms(seed: int, iteration: int, keys: pa.Array) -> np.ndarray:
    """``hash_uniform`` of a column of texts (a null one counts as "None")."""
    keys = keys.cast(pa.string()).fill_null("None")
    _, ends, data = keys.buffers()
    at = np.frombuffer(ends, np.int32, len(keys) + 1, 4 * keys.offset).tolist() if len(keys) else [0]
    start, data = f"{seed}:{iteration}:".encode(), data.to_pybytes() if data else b""
    digests = b"".join([hashlib.md5(start + data[i:j]).digest()[:8] for i, j in zip(at, at[1:])])
    return (np.frombuffer(digests, ">u8") >> np.uint64(12)) / 2.0 ** 52


def uniform(seed: int, iteration: int, key: str) -> float:
    """``hash_uniform`` of one key."""
    return float(uniforms(seed, iteration, pa.array([key]))[0])


def sweep_tasks(rows: DataFrame) -> tuple[int, int]:
    """How many tasks a sweep over the rows takes, and their number.  Each task hands on C x V sums: all cores
    take part, and there are more tasks only where the documents need them, however many partitions they came in."""
    total, entries = rows.select(F.count(F.lit(1)), F.coalesce(F.sum(F.size("pos")), F.lit(0))).first()
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-entries // TASK_ENTRIES)), total


def sweep_sums(blocks: DataFrame, seed: int, iteration: int, log_pi: np.ndarray, log_mu: np.ndarray, tasks: int):
    """One sweep over ``packed`` rows: every row draws its class under fixed parameters, and the
    draws are added up to ``(cls, n, sums)``, ``sums`` the V doubles sum of x by position.

    Every one of the ``tasks`` partitions hands on one row per class that it drew; these are added TREE
    at a time until at most TREE rows per class are left, which the caller adds."""
    params = blocks.sparkSession.sparkContext.broadcast((log_pi, np.ascontiguousarray(log_mu.T)))
    schema = "cls int, node int, n double, sums binary"

    def rows_of(cls, node, n, sums):
        return pa.RecordBatch.from_arrays(
            [pa.array(cls, pa.int32()), pa.array(node, pa.int32()), pa.array(n, pa.float64()),
             pa.array([s.tobytes() for s in sums], pa.binary())], names=["cls", "node", "n", "sums"])

    def step(batches):
        from pyspark import TaskContext
        lpi, words = params.value
        size = len(words)
        n_c, s_cw = np.zeros(len(lpi)), np.zeros(words.size)
        for part in LN.unpacked(batches):
            sizes, pos, x = _entries(part)
            c = categorical_draw(_normalised(_log_scores(sizes, pos, x, lpi, words)), uniforms(seed, iteration, part.column(0)))
            n_c += np.bincount(c, minlength=len(n_c))
            np.add.at(s_cw, np.repeat(c * size, sizes) + pos, x)
        used, node = np.flatnonzero(n_c), TaskContext.get().partitionId() // TREE
        yield rows_of(used, np.full(len(used), node), n_c[used], s_cw.reshape(len(lpi), size)[used])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_py()) for x in table.column("sums")], axis=0)
        return pa.Table.from_batches([rows_of([table.column("cls")[0].as_py()], [table.column("node")[0].as_py() // TREE],
                                              [sum(table.column("n").to_pylist())], [total])])

    sums = blocks.select("block").mapInArrow(step, schema)
    while tasks > TREE:
        sums = sums.groupBy("cls", "node").applyInArrow(add, schema)
        tasks = -(-tasks // TREE)
    return sums.select("cls", "n", "sums"), params


def sweep_draws(blocks: DataFrame, seed: int, iteration: int, log_pi: np.ndarray, log_mu: np.ndarray, kinds: dict[str, str]) -> DataFrame:
    """The class that every row of ``packed`` blocks draws under fixed parameters, as ``cluster`` behind the columns of
    ``kinds`` (doc_id and the label, with their types)."""
    params = blocks.sparkSession.sparkContext.broadcast((log_pi, np.ascontiguousarray(log_mu.T)))
    names = [*kinds, "cluster"]

    def step(batches):
        lpi, words = params.value
        for part in LN.unpacked(batches):
            keys = part.column(0)
            u = np.where(keys.is_null().to_numpy(zero_copy_only=False), -1, uniforms(seed, iteration, keys))     # none: the first class
            c = categorical_draw(_normalised(_log_scores(*_entries(part), lpi, words)), u)
            yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(c, pa.int32())], names=names)

    drawn = blocks.select("block").mapInArrow(step, ", ".join(f"`{c}` {'string' if c == 'doc_id' else kind}" for c, kind in kinds.items()) + ", cluster int")
    return drawn.withColumn("doc_id", F.col("doc_id").cast(kinds["doc_id"]))


def gibbs(rows: DataFrame, classes: int, size: int, iterations: int = 200, alpha: float = 0.5,
          beta: float = 0.5, seed: int = 7, accumulate: bool = True) -> GibbsResult:
    """Gibbs sampling of document classes, one ``sweep_sums`` over the cached documents per iteration.

    ``accumulate=True`` keeps adding the current class shares and sums to
    the running hyper-parameters (the reference's rule; on term frequencies it
    keeps the classes in use); ``accumulate=False`` is the standard conditional
    update (alpha + n_c, beta + S_c), meant for counts.

    The draws' uniforms do not depend on partitioning or retries; the sums are
    rounded to SUM_DIGITS before they feed the Dirichlet draws, so the order of
    float additions does not show."""
    bound_batches(rows.sparkSession)        # else a batch holds 64 MB of blocks, and a task waits for all of it
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("doc_id", "label") if c in rows.columns}
    parts, total = sweep_tasks(rows)
    blocks = stable(packed(rows.select(*kinds, "pos", "x")).repartition(parts))
    rng = np.random.default_rng(seed)
    a = np.full(classes, alpha)
    b = np.full((classes, size), beta)
    pi, mu = rng.dirichlet(a), _dirichlet_rows(rng, b)
    history = []
    for it in range(iterations):
        sums, sent = sweep_sums(blocks, seed, it, np.log(pi), np.log(mu), parts)
        got = sums.toArrow()
        sent.destroy()
        n_c, s_cw = np.zeros(classes), np.zeros((classes, size))
        for c, n, s in zip(*(got.column(k).to_pylist() for k in ("cls", "n", "sums")), strict=True):
            n_c[c] += n
            s_cw[c] += np.frombuffer(s)
        s_cw = np.round(s_cw, SUM_DIGITS)
        if accumulate:
            a, b = a + n_c / total, b + s_cw
        else:
            a, b = alpha + n_c, beta + s_cw
        pi, mu = rng.dirichlet(a), _dirichlet_rows(rng, b)
        history.append(n_c.tolist())
    return GibbsResult(pi, mu, history, sweep_draws(blocks, seed, iterations, np.log(pi), np.log(mu), kinds), blocks)


SUM_DIGITS = 9


def _dirichlet_rows(rng, b: np.ndarray) -> np.ndarray:
    """One Dirichlet draw per row; draws that underflow to 0 become the least positive value."""
    g = np.maximum(rng.standard_gamma(b), np.finfo(float).tiny)
    return g / g.sum(axis=1, keepdims=True)


def drawn_class(post: str, u: str) -> Column:
    """``categorical_draw`` on a posterior column."""
    fold = F.aggregate(post, F.struct(F.lit(0.0).alias("cum"), F.lit(0).alias("n")), lambda acc, p: F.struct(
        (acc["cum"] + p).alias("cum"), (acc["n"] + F.when(acc["cum"] + p <= F.col(u), 1).otherwise(0)).alias("n")))
    return F.least(fold["n"], F.size(post) - 1).cast("int")


# ------------------------------------------------------------------ reports

def cluster_sizes(assigned: DataFrame, rows: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Per cluster the number of documents and, per position, the summed
    feature values: ``(cluster, n_docs, pos, total)``."""
    sizes = assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_docs"))
    sums = (rows.select("doc_id", F.explode(F.arrays_zip("pos", "x")).alias("e")).join(assigned.select("doc_id", cluster), "doc_id")
            .groupBy(cluster, F.col("e.pos").alias("pos")).agg(F.sum("e.x").alias("total")))
    return sums.join(sizes, cluster)

def top_words(log_mu: DataFrame, vocab: DataFrame, k: int = 50, key_digits: int = 12) -> DataFrame:
    """Per class the k most probable words (ties -> smaller position)."""
    long = log_mu.select("cls", F.posexplode("log_mu").alias("pos", "lm"))
    rank_key = F.format_string(f"%.{key_digits - 1}e", F.col("lm")).cast("double")
    w = Window.partitionBy("cls").orderBy(F.desc("key"), "pos")
    ranked = long.withColumn("key", rank_key).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(vocab), "pos").select("cls", "rank", "word")


def label_shares(assigned: DataFrame, cluster: str = "cluster", label: str = "label", k: int = 3) -> DataFrame:
    """Per cluster the k most frequent true labels with their share."""
    cross = assigned.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    size = Window.partitionBy(cluster)
    shares = cross.withColumn("share", F.col("n") / F.sum("n").over(size))
    w = Window.partitionBy(cluster).orderBy(F.desc("n"), label)
    return (shares.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(cluster, "rank", label, "n", "share"))


def argmax_cluster(scored: DataFrame) -> Column:
    """Class with the largest posterior (first on ties)."""
    return (F.array_position("post", F.array_max("post")) - 1).cast("int")
