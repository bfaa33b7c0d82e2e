"""Exact n-gram Jaccard join with a token-group matrix (operator 5).

1. Every text becomes its set of word shingles.  Equal sets form one *class*;
   only one representative per class goes on, under a 64-bit key of its set.
2. Similar classes are put into *groups*: least hashes in 32 ranges (one sorted
   set gives them all), bands of four ranges, and two rounds of taking the least
   label over one's bands.  Any partition gives right results; a good one
   leaves few groups to open.
3. The token-group matrix holds, for every token, the groups whose members have
   it in their *prefix*.  With all sets in one token order (frequent tokens last, so
   shared passages don't meet), sets of Jaccard >= t share a token among the
   first n - ceil(t n) + 1 of each.  A query's overlap with a group's token union
   is bounded by its count c of matrix cells: if |x| = n has a partner of size m in
   the group, then c >= min(prefix(n) - n + a, prefix(m) - m + a) with the least
   overlap a = ceil(t (n + m) / (1 + t)).  Only (query, group) cells that reach the
   bound are opened (the larger of two sets asks), and each group for its own members.
4. Opening a group compares the whole sets, in blocks of bounded size, and
   returns a spanning forest of its links instead of all pairs.

The order of tokens is (document frequency, hash): the frequencies of all tokens are counted over all sets, and the
frequent ones go to the tasks, the most frequent first up to a bound.  So a token in a prefix has few sets unless a
set has nothing rarer, and the matrix's rows stay in proportion to the cells.  The order, like
the groups, changes the work and never the result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import bytewords as bw
from lodestar.llm import scratch
from lodestar.llm.components import components
from lodestar.llm.shingles import batch_sets, set_key

FREQUENT_DF = 12            # sets from which on a token counts as frequent
FREQUENT_TOKENS = 1 << 22   # frequent tokens sent to every task, at most (32 MB)
RANGES, BAND = 32, 4
FLUSH_TOKENS = 1 << 18      # prefix tokens that a task holds before it sends them
BUCKET_TOKENS = 750_000     # prefix tokens that meet in one reduce group, about
BLOCK_SETS, BLOCK_TOKENS = 600, 400_000
DEAL = 64                   # parts that the rows of a large group are joined in


def _prefix(n, num: int, den: int):
    return n - -(-num * n // den) + 1


def describe(documents: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, key binary, e long`` of every row: set size, 128-bit set key and its
    first half, the entity (both null for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, keys = [], []
            for _, s in batch_sets(b.column(1), width):
                n.append(len(s))
                keys.append(set_key(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array([k and entity(k) for k in keys], pa.int64())], names=["doc_id", "n", "key", "e"])
    return documents.mapInArrow(run, "doc_id long, n long, key binary, e long")


def entity(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def keyed_texts(documents: DataFrame, width: int) -> DataFrame:
    """``e, text`` of one row per entity and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            column, keys, at = bw.strings(b.column(0)), [], []
            for i, s in batch_sets(column, width):
                if len(s) and (e := entity(set_key(s))) not in seen:
                    seen.add(e)
                    keys.append(e)
                    at.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), column.take(pa.array(at, pa.int64()))], names=["e", "text"])
    return documents.select("text").mapInArrow(run, "e long, text string")


def _planes(tokens: np.ndarray) -> bytes:
    """Ascending tokens as differences, their first bytes first, then their second ones and so on: the upper ones are
    nearly all 0, which the shuffle compresses."""
    return np.ascontiguousarray(np.diff(tokens, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def _often(table: pa.Table) -> pa.Table:
    """Tokens of one range of hashes that FREQUENT_DF sets or more have."""
    tokens = np.concatenate([_unplaned(x.as_py()) for x in table.column("tokens")])
    sets = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column("sets")])
    order = np.argsort(tokens, kind="stable")
    tokens, sets = tokens[order], sets[order]
    cuts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    c = np.add.reduceat(sets, cuts, dtype=np.int64)
    kept = c >= FREQUENT_DF
    return pa.table({"t": pa.array(tokens[cuts[kept]].view(np.int64)), "c": pa.array(c[kept], pa.int64())})


def frequent_tokens(documents: DataFrame, rows: int, buckets: int, width: int, num: int, den: int) -> np.ndarray:
    """Frequent tokens, the rarest first: every token of every set is counted (one task counts equal sets
    once), in ranges of hashes as large as the ``buckets`` of prefix tokens.  No token is frequent in less than FREQUENT_DF ``rows``."""
    if rows < FREQUENT_DF:
        return np.zeros(0, np.uint64)
    ranges = -(-buckets * den // (den - num))
    edges = np.array([(k << 64) // ranges for k in range(ranges)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, parts, held = set(), [], 0

        def flush():
            tokens, sets = np.unique(np.concatenate(parts), return_counts=True)
            cuts = np.append(np.searchsorted(tokens, edges), len(tokens))
            there = np.flatnonzero(np.diff(cuts))
            own = [slice(cuts[k], cuts[k + 1]) for k in there]
            return pa.RecordBatch.from_arrays(
                [pa.array(there, pa.int64()), pa.array([_planes(tokens[x]) for x in own], pa.binary()),
                 pa.array([sets[x].astype("<u4").tobytes() for x in own], pa.binary())], names=["bucket", "tokens", "sets"])

        for b in batches:
            for _, s in batch_sets(b.column(0), width):
                if not len(s) or (e := entity(set_key(s))) in seen:
                    continue
                seen.add(e)
                parts.append(s.copy())
                held += len(s)
                if held >= FLUSH_TOKENS:
                    yield flush()
                    parts, held = [], 0
        if parts:
            yield flush()

    counted = documents.select("text").mapInArrow(run, "bucket long, tokens binary, sets binary").groupBy("bucket").applyInArrow(_often, "t long, c long")
    got = counted.orderBy(F.desc("c"), "t").limit(FREQUENT_TOKENS).select("t").toArrow().column(0).to_numpy()
    return got.astype(np.int64).view(np.uint64)[::-1].copy()


_BLOB = struct.Struct("<II")


def _blob(tokens, rows, entities, sizes) -> bytes:
    used, local = np.unique(rows, return_inverse=True)
    return b"".join([_BLOB.pack(len(tokens), len(used)), tokens.tobytes(), local.astype("<u4").tobytes(),
                     entities[used].tobytes(), sizes[used].astype("<u4").tobytes()])


def _unblob(data: bytes):
    n, m = _BLOB.unpack_from(data)
    at = _BLOB.size
    tokens = np.frombuffer(data, "<u8", n, at)
    local = np.frombuffer(data, "<u4", n, at + 8 * n)
    at += 12 * n
    return tokens, np.frombuffer(data, "<i8", m, at)[local], np.frombuffer(data, "<u4", m, at + 8 * m)[local]


def matrix_input(documents: DataFrame, frequent, buckets: int, width: int, num: int, den: int) -> DataFrame:
    """One scan gives, for every distinct set, its bands (kind 0: ``a`` band, ``b``
    entity), its frequent prefix tokens (kind 1: ``a`` token, ``b`` entity, ``n`` size), and
    packed blocks of its other prefix tokens by bucket (kind 2: ``a`` bucket)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_frequency, seen = frequent.value, set()
        place = np.argsort(by_frequency).astype(np.uint32)
        often = by_frequency[place]
        edges = np.arange(RANGES, dtype=np.uint64) << np.uint64(64 - RANGES.bit_length() + 1)
        top = np.arange(RANGES, dtype=np.uint64)
        bands, common, light = [], [], []

        def rows(kind, a, b, n, payload=None):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, np.int8)), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(payload or [None] * len(a), pa.binary())],
                names=["kind", "a", "b", "n", "payload"])

        def flush():
            if bands:
                e = np.array([x for x, _, _ in bands], np.int64)
                least = np.stack([x for _, x, _ in bands]).reshape(len(e), RANGES // BAND, BAND)
                key = np.zeros(least.shape[:2], np.uint64)
                for k in range(BAND):
                    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + least[:, :, k]
                key += np.arange(RANGES // BAND, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
                # A band without any hash says nothing; every set has another one.
                full = np.stack([x for _, _, x in bands]).reshape(least.shape).any(axis=2)
                yield rows(0, key[full].view(np.int64), np.repeat(e, full.sum(axis=1)), np.zeros(int(full.sum()), np.int64))
            if common:
                yield rows(1, *(np.concatenate(x) for x in zip(*common, strict=True)))
            if light:
                tokens = np.concatenate([t for t, _, _ in light])
                row = np.repeat(np.arange(len(light)), [len(t) for t, _, _ in light])
                entities = np.array([e for _, e, _ in light], "<i8")
                sizes = np.array([n for _, _, n in light])
                bucket = (tokens % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                tokens, row, bucket = tokens[order], row[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = [*cuts[1:], len(bucket)]
                if len(cuts):
                    yield rows(2, bucket[cuts], np.zeros(len(cuts), np.int64), np.zeros(len(cuts), np.int64),
                               [_blob(tokens[i:j], row[i:j], entities, sizes) for i, j in zip(cuts, ends, strict=True)])
            bands.clear(), common.clear(), light.clear()

        held = 0
        for b in batches:
            for _, s in batch_sets(b.column(0), width):
                n = len(s)
                if not n:
                    continue
                e = entity(set_key(s))
                if e in seen:
                    continue
                seen.add(e)
                at = np.searchsorted(s, edges)
                least = s[np.minimum(at, n - 1)]
                there = least >> np.uint64(64 - RANGES.bit_length() + 1) == top
                bands.append((e, np.where(there, least, np.uint64(0)), there))
                p = _prefix(n, num, den)
                if len(often):
                    near = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    hit = often[near] == s
                    rare, usual = s[~hit], s[hit][np.argsort(place[near[hit]])]
                else:
                    rare, usual = s, s[:0]
                light.append((rare[:p].copy(), e, n))
                if len(rare) < p:
                    t = usual[: p - len(rare)].view(np.int64)
                    common.append((t.copy(), np.full(len(t), e), np.full(len(t), n)))
                held += p
                if held >= FLUSH_TOKENS:
                    yield from flush()
                    held = 0
        yield from flush()

    return documents.mapInArrow(run, "kind byte, a long, b long, n long, payload binary")


def _repeated(table: pa.Table, num: int, den: int) -> pa.Table:
    """Tokens of a bucket that several entities of near enough sizes have, with those entities."""
    parts = [_unblob(x.as_py()) for x in table.column("payload")]
    tokens, entities, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    # Only tokens that come again can matter; of these, each entity once.
    order = np.argsort(tokens, kind="stable")
    again = np.zeros(len(order), bool)
    again[1:] = tokens[order][1:] == tokens[order][:-1]
    again[:-1] |= again[1:]
    order = order[again]
    tokens, entities, sizes = tokens[order], entities[order], sizes[order].astype(np.int64)
    order = np.lexsort((entities, sizes, tokens))
    tokens, entities, sizes = tokens[order], entities[order], sizes[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (entities[1:] != entities[:-1])
    tokens, entities, sizes = tokens[fresh], entities[fresh], sizes[fresh]
    # By size, the nearest neighbours of a set in the run of its token are the ones beside it.
    near = (tokens[1:] == tokens[:-1]) & (num * sizes[1:] <= den * sizes[:-1])
    kept = np.zeros(len(tokens), bool)
    kept[1:] |= near
    kept[:-1] |= near
    return pa.table({"x": pa.array(tokens[kept].view(np.int64)), "e": pa.array(entities[kept]),
                     "n": pa.array(sizes[kept])})


def form_groups(bands: DataFrame) -> DataFrame:
    """``(e, g)``: two rounds of the least label over the bands of each entity."""
    label = bands.groupBy("e").agg(F.min("e").alias("g"))
    for _ in range(2):
        before = label
        least = bands.join(label, "e").groupBy("band").agg(F.min("g").alias("g"))
        label = scratch.stage(bands.join(least, "band").groupBy("e").agg(F.min("g").alias("g")), "groups")
        if hasattr(before, "scratch_path"):
            scratch.discard(before)
    return label


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    row = np.repeat(np.arange(n, dtype=np.int64), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.lexsort((row, flat))
    flat, row = flat[order], row[order]
    cuts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    count = np.diff(np.append(cuts, len(flat)))
    out = np.zeros((n, n), np.float32)
    few = 12
    for d in range(2, few + 1):                     # rare tokens: their pairs
        at = cuts[count == d]
        if len(at):
            r = row[at[:, None] + np.arange(d)]
            i, j = np.triu_indices(d, 1)
            out += np.bincount((r[:, i] * n + r[:, j]).ravel(), minlength=n * n).reshape(n, n)
    often = np.flatnonzero(count > few)             # the others: products of 0/1 columns
    for k in range(0, len(often), 4096):
        chosen = often[k: k + 4096]
        col = np.repeat(np.arange(len(chosen)), count[chosen])
        at = np.repeat(cuts[chosen] - np.concatenate(([0], np.cumsum(count[chosen])[:-1])), count[chosen]) + np.arange(len(col))
        m = np.zeros((n, len(chosen)), np.float32)
        m[row[at], col] = 1
        out += np.triu(m @ m.T, 1)
    return out


def open_group(texts: pa.Array, entities: list[int], member: list[bool], width: int, num: int, den: int) -> list[tuple[int, int]]:
    """Links of one block of a group as a spanning forest of its entities."""
    sets, rows, seen = [], [], set()
    for i, s in batch_sets(texts, width):
        if len(s) and entities[i] not in seen and entity(set_key(s)) == entities[i]:
            seen.add(entities[i])
            sets.append(s.copy())
            rows.append(i)
    inside = [k for k, i in enumerate(rows) if member[i]]
    if not inside:
        return []
    union = np.unique(np.concatenate([sets[k] for k in inside]))
    # A query whose overlap with the group's whole token union is too small has no link in it.
    kept = [k for k, i in enumerate(rows) if member[i]
            or den * np.isin(sets[k], union, assume_unique=True).sum() >= num * len(sets[k])]
    sets, rows = [sets[k] for k in kept], [rows[k] for k in kept]
    if len(sets) < 2:
        return []
    size = np.array([len(s) for s in sets])
    # inter / (a + b - inter) >= num / den
    linked = (num + den) * _overlaps(sets) >= num * (size[:, None] + size[None, :])
    linked = np.triu(linked, 1)
    linked |= linked.T
    np.fill_diagonal(linked, True)
    label = np.arange(len(sets))
    while True:
        now = np.where(linked, label[None, :], len(sets)).min(axis=1)
        now = now[now]
        if (now == label).all():
            break
        label = now
    return [(entities[rows[k]], entities[rows[label[k]]]) for k in range(len(sets)) if label[k] != k]


def jaccard_components(documents: DataFrame, width: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """Every row of ``documents(doc_id, text)`` with ``n_shingles`` and
    ``component_id``: the smallest doc_id that links lead to, links joining texts
    whose shingle sets have Jaccard similarity >= num/den.

    Null and empty texts and texts without words have an empty set, no link and
    their own doc_id as component.  Repeated rows and equal texts share a
    component.  Rows without a doc_id link like any others; a component without any doc_id
    has the null one.  A doc_id with several texts stands in each text's component.  Other columns are ignored.
    """
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = scratch.stage(describe(documents, width), "sets")
    rows, tokens = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                  int(tokens) * (den - num) // den // BUCKET_TOKENS + 1)
    frequent = spark.sparkContext.broadcast(frequent_tokens(documents, rows, buckets, width, num, den))
    parts = scratch.stage(matrix_input(documents.select("text"), frequent, buckets, width, num, den), "matrix", "kind")

    bands = parts.where("kind = 0").select(F.col("a").alias("band"), F.col("b").alias("e"))
    groups = form_groups(bands)
    light = (parts.where("kind = 2").select(F.col("a").alias("bucket"), "payload").groupBy("bucket")
             .applyInArrow(lambda t: _repeated(t, num, den), "x long, e long, n long"))
    usual = parts.where("kind = 1").select(F.col("a").alias("x"), F.col("b").alias("e"), "n").distinct()
    cells = scratch.stage(light.unionByName(usual).join(groups, "e"), "cells")

    # Token-group matrix with the sizes of the members behind each cell; tokens of one group only tell nothing.
    matrix = cells.groupBy("x", "g").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    shared = matrix.groupBy("x").agg(F.min("g").alias("g0"), F.max("g").alias("g1")).where("g0 <> g1").select("x")
    matrix = matrix.join(shared, "x", "left_semi").withColumnRenamed("g", "h")
    least = lambda n, m: f"1 - ceil({num} * {n} / {den}) + ceil({num} * ({n} + {m}) / {num + den})"
    opened = (cells.join(matrix, "x")
              # The larger of two sets asks for the smaller.
              .where(f"g <> h and lo <= n and {num} * n <= {den} * hi")
              .groupBy("e", "h").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
              .withColumns({"lo": F.greatest("lo", F.expr(f"ceil({num} * n / {den})")),
                            "hi": F.least("hi", "n")})
              # Sizes differ the least bound only through the extreme ones; one is given for rounding.
              .where(f"c >= least({least('n', 'lo')}, {least('hi', 'n')}) - 1"))
    opened = scratch.stage(opened.select("e", "h"), "opened")

    crowd = groups.groupBy("g").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("g").alias("h"))
    wanted = crowd.unionByName(opened.select("h")).distinct()
    work = (groups.withColumnRenamed("g", "h").join(wanted, "h", "left_semi").select("e", "h", F.lit(True).alias("member"))
            .unionByName(opened.select("e", "h", F.lit(False).alias("member"))))
    size = sets.where("e is not null").groupBy("e").agg(F.max("n").alias("n"))
    work = scratch.stage(work.join(size, "e"), "work")
    blocks = work.groupBy("h").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS),
                                              F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    # Only groups of several blocks are joined, under DEAL salts, so the rows of a large one meet in no single task.
    large = blocks.where("blocks > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))))
    dealt = (work.withColumn("salt", F.pmod(F.xxhash64("e"), F.lit(DEAL)).cast("int")).join(large, ["h", "salt"], "left")
             .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("mine", F.pmod(F.xxhash64("e", F.lit(1)), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("h", "e", "member", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))

    def run(table: pa.Table) -> pa.Table:
        got = open_group(table.column("text"), table.column("e").to_pylist(), table.column("member").to_pylist(), width, num, den)
        return pa.table({"u": pa.array([u for u, _ in got], pa.int64()), "v": pa.array([v for _, v in got], pa.int64())})

    # The same shuffle join at every size (a small input's rows would else be broadcast).
    links = (keyed_texts(documents, width).join(dealt.hint("merge"), "e").select("h", "i", "j", "e", "member", "text")
             .groupBy("h", "i", "j").applyInArrow(run, "u long, v long"))
    found = components(links)
    scratch.discard(parts, groups, cells, opened, work)

    # A component is named by its least doc_id.
    of_class = sets.where("e is not null").groupBy("e").agg(F.min("doc_id").alias("least"))
    named = of_class.join(found, F.col("e") == F.col("vertex"), "left").select("e", "least", F.coalesce("component", "e").alias("c"))
    least = named.groupBy("c").agg(F.min("least").alias("component"))
    named = named.join(least, "c").select("e", "component")
    return (sets.join(named, "e", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))
