"""Text features in sparse format.

Documents become ``(doc_id, pos[], n[])`` rows, written once, and from these
``(doc_id, pos, ...)`` rows; nothing is ever densified to a vocabulary-wide
array.  The dictionary has at most ``size`` rows by construction, which is the
bound that licenses sending it to every task: no token is ever shuffled, only
one pair of arrays per document.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.session import staged


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """F1 per document: ``(doc_id, words)``."""
    return docs.select(F.col(id_col).alias("doc_id"), T.tokens(text_col).alias("words"))


def all_words(tokenized: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """One row per token occurrence, optionally without stop words.

    ``explode_outer`` + an explicit null filter: a plain ``explode`` makes
    Catalyst infer ``isnotnull(words) AND size(words) > 0`` and push it below
    the projection, which would tokenise every document twice."""
    words = (tokenized.select("doc_id", F.explode_outer("words").alias("word"))
             .filter(F.col("word").isNotNull() & (F.col("word") != "")))
    if stop_words:
        words = words.filter(~F.col("word").isin(stop_words))
    return words


def word_counts(tokenized: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """``(word, n)``; partial aggregation runs before the shuffle, so a
    hot word is combined map-side and never concentrates raw rows."""
    return (all_words(tokenized, stop_words).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")))


def vocabulary(tokenized: DataFrame, size: int,
               stop_words: list[str] | None = None) -> DataFrame:
    """T3 + W1: the ``size`` most frequent words, ``pos`` = 0-based rank by
    (count desc, word asc).  The window sees at most ``size`` rows."""
    top = (word_counts(tokenized, stop_words)
           .orderBy(F.desc("n"), F.asc("word")).limit(size))
    rank = Window.orderBy(F.desc("n"), F.asc("word"))
    return top.select("word", (F.row_number().over(rank) - 1).cast("int").alias("pos"))


def doc_terms(tokenized: DataFrame, vocab: DataFrame,
              stop_words: list[str] | None = None) -> DataFrame:
    """In-vocabulary token occurrences ``(doc_id, pos)``; out-of-vocabulary
    tokens drop out through the inner join with the broadcast dictionary."""
    return (all_words(tokenized, stop_words)
            .join(F.broadcast(vocab), "word")
            .select("doc_id", "pos"))


def doc_positions(terms: DataFrame) -> DataFrame:
    """``(doc_id, positions)``: the in-vocabulary occurrences of each document
    (its own length bounds the array).  The only shuffle of the chain; the
    filter, always true, keeps every branch reading both columns, so all
    branches share one exchange."""
    return (terms.groupBy("doc_id").agg(F.collect_list("pos").alias("positions"))
            .filter(F.size("positions") > 0))


def term_counts(docs: DataFrame) -> DataFrame:
    """A11, M1/W2 in one pass over ``doc_positions``: ``(doc_id, pos, n, tf)``
    with ``tf = n / positions of the document`` (sums to 1 per document).  The
    grouping keeps the partitioning by ``doc_id``: no shuffle."""
    each = docs.select("doc_id", F.size("positions").alias("total"), F.explode("positions").alias("pos"))
    counts = each.groupBy("doc_id", "total", "pos").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("doc_id", "pos", "n", (F.col("n") / F.col("total")).alias("tf"))


# ASCII letters in lower case, every other byte a space: F1 on UTF-8 bytes.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in range(256))
MERGE_ENTRIES = 1 << 20     # words of texts, or entries of one document, that a task holds before it adds them up


def _arrays(keys: list, kind: pa.DataType, pos: list, n: list) -> pa.RecordBatch:
    """``(doc_id, pos, n)`` from one numpy array of each per document."""
    return _lists(keys, kind, [len(p) for p in pos], np.concatenate([np.zeros(0, np.int32), *pos]), np.concatenate([np.zeros(0, np.int64), *n]))


def _lists(keys: list, kind: pa.DataType, sizes, pos: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """``(doc_id, pos, n)`` from the entries of all documents, one after the other, and their numbers."""
    ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.ListArray.from_arrays(ends, pa.array(pos, pa.int32())),
                                       pa.ListArray.from_arrays(ends, pa.array(n, pa.int64()))], names=["doc_id", "pos", "n"])


def _added(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Ascending positions and summed counts of several ``(pos, n)``."""
    if len(parts) == 1:
        return parts[0]
    pos, back = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    total = np.zeros(len(pos), np.int64)
    np.add.at(total, back, np.concatenate([n for _, n in parts]))
    return pos, total


def _merged(batches):
    """Rows ``(doc_id, pos, n)`` sorted by id, those of one id added up as they stream by."""
    key, parts, held = None, [], 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        if ids and not any(a == b for a, b in zip([key if parts else object(), *ids], ids)):
            # Every id is new: the rows go on as they are, but the last, whose id may go on.
            if parts:
                p, m = _added(parts)
                yield _arrays([key], batch.schema.field(0).type, [p], [m])
            yield batch.slice(0, len(ids) - 1)
            end = batch.slice(len(ids) - 1)
            key, kind = ids[-1], batch.schema.field(0).type
            parts = [tuple(end.column(c).flatten().to_numpy(zero_copy_only=False).copy() for c in (1, 2))]
            held = len(parts[0][0])
            continue
        keys, pos, n = [], [], []
        ends = batch.column(1).offsets.to_numpy()
        flat = [batch.column(c).values.to_numpy(zero_copy_only=False) for c in (1, 2)]
        for k, now in enumerate(ids):
            if parts and now != key:
                p, m = _added(parts)
                keys.append(key), pos.append(p), n.append(m)
                parts, held = [], 0
            key = now
            parts.append(tuple(x[ends[k]: ends[k + 1]] for x in flat))
            held += ends[k + 1] - ends[k]
            if held > MERGE_ENTRIES and len(parts) > 1:
                parts = [_added(parts)]
                held = 0
        yield _arrays(keys, batch.schema.field(0).type, pos, n)
        kind = batch.schema.field(0).type
        parts = [tuple(x.copy() for x in part) for part in parts]       # nothing of the batch stays
    if parts:
        p, m = _added(parts)
        yield _arrays([key], kind, [p], [m])


def encoded(docs: DataFrame, words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """J1 + A11 per document: ``(doc_id, pos[], n[], total)``, the ascending dictionary positions (of ``words``, in
    order), their occurrences and the sum of these; rows of one id are one document, documents without a word of the
    dictionary drop out.  A text is counted where it is read, so one short row per document is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast({w.encode(): k for k, w in enumerate(words)})

    def count(batches):
        index, size = sent.value.get, max(1, len(sent.value))

        def rows(keys, at, sizes, found, kind):
            """Rows of the documents with an entry: ``found`` the places of all words (-1: none), ``at`` the document of each text."""
            place = np.array(found, np.int64)
            cells = (np.repeat(np.array(at, np.int64), sizes) * size + place)[place >= 0]
            cells, n = np.unique(cells, return_counts=True)
            many = np.bincount(cells // size, minlength=len(keys))
            return _lists([k for k, m in zip(keys, many) if m], kind, many[many > 0], cells % size, n)

        for batch in batches:
            kind = batch.schema.field(0).type
            numbers, at, sizes, found = {}, [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if text is not None:
                    words = text.translate(_LETTERS).split()
                    at.append(numbers.setdefault(key, len(numbers)))
                    sizes.append(len(words))
                    found.extend(map(index, words, repeat(-1)))
                    if len(found) > MERGE_ENTRIES:
                        yield rows(list(numbers), at, sizes, found, kind)
                        numbers, at, sizes, found = {}, [], [], []
            yield rows(list(numbers), at, sizes, found, kind)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, pos array<int>, n array<bigint>"
    counted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(count, schema)
    merged = counted.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(_merged, schema)
    return merged.withColumn("total", F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b))


def long_counts(arrays: DataFrame) -> DataFrame:
    """``(doc_id, pos, n, tf)`` of ``encoded`` documents, one row per entry."""
    each = arrays.select("doc_id", "total", F.explode(F.arrays_zip("pos", "n")).alias("e"))
    return each.select("doc_id", F.col("e.pos").alias("pos"), F.col("e.n").alias("n"), (F.col("e.n") / F.col("total")).alias("tf"))


def tf_arrays(arrays: DataFrame) -> DataFrame:
    """``(doc_id, pos[], x[])`` of ``encoded`` documents with x the term frequencies."""
    return arrays.select("doc_id", "pos", F.transform("n", lambda v: v / F.col("total")).alias("x"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """Number of documents containing each position."""
    return counts.groupBy("pos").agg(F.count_if(F.col("n") > 0).alias("df"))


def inverse_document_frequency(dfreq: DataFrame, n_docs: Column) -> DataFrame:
    """M2: ``idf = ln(N / df)``.  ``n_docs`` is a scalar column (e.g. a scalar
    subquery counting every input line), not ``ln((N+1)/(df+1))``."""
    return dfreq.select("pos", F.ln(n_docs.cast("double") / F.col("df")).alias("idf"))


def tfidf(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """``(doc_id, pos, tfidf)`` = tf * idf (idf broadcast, <= size rows)."""
    return (tf.join(F.broadcast(idf), "pos")
            .select("doc_id", "pos", (F.col("tf") * F.col("idf")).alias("tfidf")))


def doc_count(docs: DataFrame) -> Column:
    """Scalar subquery ``count(*)`` (planned as a separate small job, no join)."""
    return docs.select(F.count(F.lit(1))).scalar()


def position_lines(docs: DataFrame) -> DataFrame:
    """A10 + K2: ``doc_id,p1,p2,...`` with every occurrence, positions ascending."""
    ordered = docs.select("doc_id", F.sort_array("positions").alias("positions"))
    return ordered.select("doc_id", T.join_positions("doc_id", "positions").alias("line"))


class TextFeatures:
    """The full chain F1 -> A8 -> T3 -> J1 -> A11 -> M1 -> A12 -> M2 -> M3 for
    one corpus, exposing each stage as a DataFrame.

    The texts are read twice: for the dictionary, which comes to the driver (at
    most ``size`` words), and for the counts of each document.  These are
    written once under the checkpoint folder (``arrays``); every branch and
    every later job reads only the columns it needs of them."""

    def __init__(self, docs: DataFrame, size: int, stop_words: list[str] | None = None,
                 id_col: str = "doc_id", text_col: str = "text", n_docs: Column | None = None):
        self.size = size
        self.tokenized = tokenize(docs, id_col, text_col)
        words = vocabulary(self.tokenized, size, stop_words).toArrow().sort_by("pos")
        self.vocab = docs.sparkSession.createDataFrame(words)
        self.words = words.column("word").to_pylist()
        self.arrays = staged(encoded(docs, self.words, id_col, text_col), "documents")
        self.counts = long_counts(self.arrays)
        self.tf = self.counts.drop("n")
        self.rows = tf_arrays(self.arrays)
        self.df = document_frequency(self.counts)
        self.n_docs = n_docs if n_docs is not None else doc_count(docs)
        self.idf = inverse_document_frequency(self.df, self.n_docs)
        self.tfidf = tfidf(self.tf, self.idf)

    @property
    def docs(self) -> DataFrame:
        """``(doc_id, positions)``: every occurrence, as ``doc_positions``."""
        each = F.transform(F.arrays_zip("pos", "n"), lambda e: F.array_repeat(e["pos"], e["n"].cast("int")))
        return self.arrays.select("doc_id", F.flatten(each).alias("positions"))

    def encode(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Counts ``(doc_id, pos[], n[], total)`` of other documents under this fitted dictionary."""
        return encoded(docs, self.words, id_col, text_col)
