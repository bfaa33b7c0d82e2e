"""MinHash near-duplicates with sequential Bayesian verification (operator 13).

1. Every text becomes its set of word shingles; rows with equal sets form one *class*
   under a 128-bit key, and only classes go on.
2. 192 minimum hashes in 32 bands of 6 give every class 32 band keys.  A pair of
   Jaccard similarity 0.85 shares no band with a chance of 3 in 10^7 (0.9: 3 in 10^11).
3. A class attends a group for each of its shared bands: the group is named by the least
   class that a first look over the bands of the band's members finds, so one
   group of copies attends one group, and every pair that shares a band meets in one.
4. In a group, pairs are compared by batches of 32 signature values.  With a uniform
   prior, m matches among n values leave ``P(J >= t) = P(Binomial(n + 1, t) <= m)``; a
   pair goes when that falls below MISS.  Survivors are verified on the full
   sets; pairs that links already join are not looked at.
5. A group of more than one block first meets in blocks with eight leaders.  What its
   main component leaves is then compared with all, block by block: a large group of near
   copies costs one pass, not its square.

Tasks return the links that join something new, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import bytewords as bw
from lodestar.llm import scratch
from lodestar.llm.components import components
from lodestar.llm.shingles import batch_sets, set_key

BANDS, ROWS = 32, 6
BATCH = 32                  # signature values compared at a time
MISS = 1e-9                 # chance of similarity >= t below which a pair goes
LEADERS = 8
BLOCK_SETS, BLOCK_TOKENS = 1000, 1_000_000

_J = bw.finalise(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_TIMES, _FLIP = (_J >> np.uint64(32)).astype(np.uint32) | np.uint32(1), _J.astype(np.uint32)


def minhashes(flat: np.ndarray, starts: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Signature values ``lo..hi`` of non-empty sets; set i is ``flat[starts[i]:starts[i+1]]``."""
    x = (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts) - 1, hi - lo), np.uint32)
    for j in range(lo, hi):
        out[:, j - lo] = np.minimum.reduceat((x ^ _FLIP[j]) * _TIMES[j], starts[:-1])
    return out


def band_keys(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    least = minhashes(flat, starts, 0, BANDS * ROWS).reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    for k in range(ROWS):
        key = bw.finalise(key + least[:, :, k])
    return key.view(np.int64)


def least_matches(num: int, den: int, miss: float = MISS) -> list[int]:
    """Fewest matches after each batch that leave a pair in play."""
    t, out = num / den, []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        chance = 0.0
        for m in range(n + 1):
            chance += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                break
        out.append(m)
    return out


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])))


def describe(documents: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, key`` of every row (key null for an empty set), and ``bands`` on
    the first row of each key in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            column = bw.strings(b.column(1))
            for lo, hi in bw.slices(column):
                n, keys, bands, fresh, at = [], [], [None] * (hi - lo), [], []
                for i, s in batch_sets(column.slice(lo, hi - lo), width):
                    n.append(len(s))
                    keys.append(set_key(s) if len(s) else None)
                    if len(s) and keys[-1] not in seen:
                        seen.add(keys[-1])
                        fresh.append(s)
                        at.append(i)
                if fresh:
                    for i, row in zip(at, band_keys(*_flat(fresh)), strict=True):
                        bands[i] = row
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "key", "bands"])
    return documents.mapInArrow(run, "doc_id long, n long, key binary, bands array<long>")


def keyed_texts(documents: DataFrame, width: int) -> DataFrame:
    """``key, text`` of one row per key and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            column, keys, at = bw.strings(b.column(0)), [], []
            for i, s in batch_sets(column, width):
                if len(s) and (k := set_key(s)) not in seen:
                    seen.add(k)
                    keys.append(k)
                    at.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), column.take(pa.array(at, pa.int64()))],
                                             names=["key", "text"])
    return documents.select("text").mapInArrow(run, "key binary, text string")


def new_links(sets: list[np.ndarray], pivot: np.ndarray, label: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Links between sets of different ``label`` that join something new, each between
    a pivot and another set."""
    flat, starts = _flat(sets)
    size = np.diff(starts)
    tokens, local = np.unique(flat, return_inverse=True)
    mark = np.zeros(len(tokens), bool)
    known: list[np.ndarray] = []
    enough = least_matches(num, den)
    label = label.copy()
    done = np.zeros(len(sets), bool)
    out = []

    def values(k: int) -> np.ndarray:
        while len(known) <= k:
            known.append(minhashes(flat, starts, BATCH * len(known), BATCH * (len(known) + 1)))
        return known[k]

    for p in np.flatnonzero(pivot):
        done[p] = True
        near = (num * np.maximum(size, size[p]) <= den * np.minimum(size, size[p])) & (label != label[p]) & ~done
        left = np.flatnonzero(near)
        same = np.zeros(len(left), np.int64)
        for k, least in enumerate(enough):
            if not len(left):
                break
            v = values(k)
            same = same + (v[left] == v[p]).sum(axis=1)
            left, same = left[same >= least], same[same >= least]
        if not len(left):
            continue
        mark[local[starts[p]: starts[p + 1]]] = True
        at = np.repeat(starts[left] - np.cumsum(size[left]) + size[left], size[left]) + np.arange(size[left].sum())
        both = np.add.reduceat(mark[local[at]].astype(np.int64), np.cumsum(size[left]) - size[left])
        mark[local[starts[p]: starts[p + 1]]] = False
        for q in left[den * both >= num * (size[left] + size[p] - both)]:
            if label[q] != label[p]:
                label[label == label[q]] = label[p]
                out.append((int(p), int(q)))
    return out


def _meet(table: pa.Table, width: int, num: int, den: int) -> pa.Table:
    """One block of a group: rows ``key, pivot, label, text``; a key's rows count once."""
    keys, pivots, labels = (table.column(c).to_pylist() for c in ("key", "pivot", "label"))
    first: dict[bytes, int] = {}
    sets, pivot, names = [], [], []
    for i, s in batch_sets(table.column("text"), width):
        if keys[i] in first:
            pivot[first[keys[i]]] |= pivots[i]
        elif len(s):
            first[keys[i]] = len(sets)
            sets.append(s.copy())
            pivot.append(pivots[i])
            names.append(labels[i])
    held, number = list(first), {}
    label = np.array([number.setdefault(x, len(number)) for x in names], np.int64)
    got = new_links(sets, np.array(pivot, bool), label, num, den) if len(sets) > 1 else []
    return pa.table({"u": pa.array([held[p] for p, _ in got], pa.binary()), "v": pa.array([held[q] for _, q in got], pa.binary())})


def _links(work: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Links of ``work(h, a, b, key, pivot, label)``, one task group per (h, a, b)."""
    rows = work.join(texts.hint("merge"), "key").select("h", "a", "b", "key", "pivot", "label", "text")
    return rows.groupBy("h", "a", "b").applyInArrow(lambda t: _meet(t, width, num, den), "u binary, v binary")


def _block(count: str):
    return F.pmod(F.xxhash64("key"), F.col(count)).cast("int")


def attendance(classes: DataFrame) -> DataFrame:
    """``(h, key, n)``: the groups that a class attends, from ``classes(key, n, bands)``."""
    bands = classes.select("key", "n", F.explode("bands").alias("band"))
    # Bands that several classes have; their least class.
    lead = bands.groupBy("band").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least <> most").drop("most")
    bands = scratch.stage(bands.join(lead, "band"), "bands")
    label = bands.groupBy("key").agg(F.min("least").alias("label"))
    met = bands.join(label, "key").groupBy("band").agg(F.min("label").alias("h"))
    found = scratch.stage(bands.select("band", "key", "n").join(met, "band").select("h", "key", "n").distinct(), "attends")
    scratch.discard(bands)
    return found


def near_duplicates(documents: DataFrame, width: int = 5, num: int = 17, den: int = 20) -> DataFrame:
    """Every row of ``documents(doc_id, text)`` with ``n_shingles``, ``component_id`` (the
    smallest doc_id reachable by links of Jaccard similarity >= num/den) and ``kept``.

    Null and empty texts and texts without words have an empty set, no link and their own
    doc_id as component.  Repeated rows and equal sets share a component.  Rows without a doc_id
    link like any others; a component without any doc_id has the null one.  ``kept`` is
    doc_id = component_id, null equal to null.  A doc_id with several texts stands in each text's
    component.  Other columns are ignored.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = scratch.stage(describe(documents, width), "rows")
    classes = rows.where("bands is not null").dropDuplicates(["key"]).select("key", "n", "bands")
    attends = attendance(classes)
    lead = F.array(*[F.min(F.struct(F.xxhash64("key", F.lit(s)), "key")).getField("key") for s in range(LEADERS)])
    groups = scratch.stage(attends.groupBy("h").agg(
        F.count(F.lit(1)).alias("k"), lead.alias("leaders"),
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks"))
        .where("k > 1"), "groups")
    large = groups.where("blocks > 1")
    here = attends.join(groups.select("h", "blocks"), "h")
    first = (here.select("h", _block("blocks").alias("a"), F.lit(-1).alias("b"), "key", (F.col("blocks") == 1).alias("pivot"))
             .unionByName(_led(large)))
    texts = keyed_texts(documents, width)
    links = scratch.stage(_links(first.withColumn("label", F.col("key")), texts, width, num, den), "links")
    joined = components(links)

    if large.limit(1).count():
        # What the main component of a large group leaves meets the whole group, block by block.
        name = joined.withColumnRenamed("vertex", "key").withColumnRenamed("component", "label")
        there = (attends.join(large.select("h"), "h").join(name, "key", "left")
                 .withColumn("label", F.coalesce("label", "key")))
        main = large.select("h", F.col("leaders")[0].alias("key")).join(name, "key", "left").select("h", F.coalesce("label", "key").alias("main"))
        there = scratch.stage(there.join(main, "h").withColumn("rest", F.col("label") != F.col("main")), "large")
        blocks = lambda c: F.coalesce(F.greatest(F.ceil(F.count(F.when(c, 1)) / BLOCK_SETS),
                                                 F.ceil(F.sum(F.when(c, F.col("n"))) / BLOCK_TOKENS)), F.lit(0)).cast("int")
        counted = there.groupBy("h").agg(blocks(F.col("rest")).alias("r"), blocks(~F.col("rest")).alias("m")).where("r > 0")
        dealt = there.join(counted, "h").withColumn("mine", F.when(F.col("rest"), _block("r")).otherwise(_block("m")))
        one = dealt.where("rest")
        meets = lambda d, a, b, pivot: d.select("h", a.alias("a"), b.alias("b"), "key", pivot.alias("pivot"), "label")
        other = F.explode(F.sequence(F.lit(0), F.col("r") - 1))
        work = (meets(one.where("m > 0").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1))),
                      F.col("mine"), -1 - F.col("o"), F.lit(True))
                .unionByName(meets(dealt.where("not rest").withColumn("o", other), F.col("o"), -1 - F.col("mine"), F.lit(False)))
                .unionByName(meets(one.withColumn("o", other), F.least("mine", "o"), F.greatest("mine", "o"), F.col("mine") <= F.col("o"))))
        more = scratch.stage(_links(work, texts, width, num, den), "links")
        joined = components(links.unionByName(more))
        scratch.discard(there, more)
    scratch.discard(attends, groups, links)

    of_class = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = of_class.join(joined, F.col("key") == F.col("vertex"), "left").select("key", "least", F.coalesce("component", "key").alias("c"))
    least = named.groupBy("c").agg(F.min("least").alias("component_id"))
    named = named.join(least, "c").select("key", "component_id")
    out = rows.drop("bands").join(named, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _led(large: DataFrame) -> DataFrame:
    """The leaders of a large group, in every block."""
    return (large.select("h", "blocks", F.explode(F.array_distinct("leaders")).alias("key"))
            .select("h", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("a"), F.lit(-1).alias("b"), "key", F.lit(True).alias("pivot")))
