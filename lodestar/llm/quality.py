"""Quality by a regularised quadratic discriminant (operator 1).

A text is a point of transformed statistics of its bytes, words and lines.  Each
class has a Gaussian whose covariance is shrunk towards the pooled one and
towards a multiple of the identity; the model keeps the Cholesky factors, so the
score of a batch is two triangular products.  The difference of log densities
(Mahalanobis distances and log determinants) plus the log odds of the classes,
divided by a temperature fitted on labelled rows, gives a score in 0..1.
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
from lodestar.llm.toxicity import logistic, training_sample

SAMPLE_GOOD, SAMPLE_BAD = 16000, 16000      # labelled texts that the model is fitted on, about
POOLED, ROUND = 0.3, 0.02                   # shrinkage towards the pooled covariance and the identity

STATISTICS = ("words with doubled marks", "upper-case words", "symbols", "bars", "exclamations", "word repeated at once",
              "repeated words", "words in lines of marks")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*@^~<>{}[]_=+\\/|"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWER = np.zeros(256, bool)
_LOWER[0x61:0x7B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_MARK = _SYMBOL.copy()
_MARK[0x21] = True


def _ratio(k: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Square root of a share, drawn towards 0 where there is little text."""
    return np.sqrt(k / (n + 5.0))


def statistics(column: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text (all 0 without words)."""
    w = bw.scan(column)
    n_docs = len(w.counts)
    offs = bw.offsets_of(column)
    offs = offs - offs[0]
    raw = column.buffers()[2]
    first = bw.offsets_of(column)[0]
    data = np.frombuffer(raw, np.uint8)[first: first + offs[-1]] if raw is not None and offs[-1] else np.zeros(0, np.uint8)

    def by_doc(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return (total[offs[1:]] - total[offs[:-1]]).astype(float)

    def by_word(flags: np.ndarray) -> np.ndarray:
        return np.bincount(w.doc[flags], minlength=n_docs).astype(float)

    def in_word(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[w.end] - total[w.start]

    words = w.counts.astype(float)
    solid = by_doc(bw.NOT_SPACE[data])
    hashes = w.hashes()
    last = data[w.end - 1] if len(w.end) else data[:0]
    before = data[np.maximum(w.end - 2, 0)] if len(w.end) else data[:0]
    doubled = _MARK[last] & _MARK[before] & (w.end - w.start >= 2)
    upper = (in_word(_UPPER[data]) >= 2) & (in_word(_LOWER[data] | _DIGIT[data]) == 0)
    again, fresh = np.zeros(len(hashes), bool), np.ones(len(hashes), bool)
    order = np.lexsort((hashes, w.doc))
    if len(hashes) > 1:
        again[1:] = (hashes[1:] == hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
    distinct = np.bincount(w.doc[order][fresh], minlength=n_docs)
    marked = again      # words in lines of which half the words are marked
    if len(hashes):
        line = np.cumsum(data == 0x0A)[w.start]
        head = np.concatenate(([True], (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])))
        line = np.cumsum(head) - 1
        some = doubled | upper | again | (last == 0x7C)
        marked = (np.bincount(line, some) * 2 >= np.bincount(line))[line]
    # The share of repeated words grows with the length by itself, like a square root.
    repeated = np.maximum(0, words - distinct) / np.maximum(1, words) ** 0.5 / 30
    return np.stack([
        _ratio(by_word(doubled), words), _ratio(by_word(upper), words), _ratio(by_doc(_SYMBOL[data]), solid),
        _ratio(by_doc(data == 0x7C), words), _ratio(by_doc(data == 0x21), words), _ratio(by_word(again), words),
        np.tanh(repeated), _ratio(by_word(marked), words)], axis=1)


# --- model ---------------------------------------------------------------------

@dataclass
class Discriminant:
    mean: np.ndarray        # by class
    factor: np.ndarray      # inverse Cholesky factor of each class's covariance, computed once
    constant: np.ndarray    # log odds minus half the log determinant
    slope: float            # of the score in the difference of log densities
    shift: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        density = []
        for mean, factor, constant in zip(self.mean, self.factor, self.constant, strict=True):
            z = (x - mean) @ factor.T
            density.append(constant - 0.5 * (z * z).sum(axis=1))
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.shift, -40, 40)))


@dataclass
class Constant:
    """Without labels of both classes there is nothing to tell apart."""

    value: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def discriminant(x: np.ndarray, y: np.ndarray) -> Discriminant | Constant:
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return Constant(0.0 if (y == 0).any() and not (y == 1).any() else 1.0)
    d = x.shape[1]
    own = [np.cov(x[y == c].T, bias=True) + 1e-9 * np.eye(d) for c in (0, 1)]
    share = np.array([(y == c).mean() for c in (0, 1)])
    pooled = share[0] * own[0] + share[1] * own[1]
    factors, constants = [], []
    for c in (0, 1):
        s = (1 - POOLED) * own[c] + POOLED * pooled
        s = (1 - ROUND) * s + ROUND * np.trace(s) / d * np.eye(d)
        factor = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(factor))
        constants.append(np.log(share[c]) - np.log(np.diag(factor)).sum())
    model = Discriminant(np.stack([x[y == c].mean(axis=0) for c in (0, 1)]), np.stack(factors), np.array(constants), 1.0, 0.0)
    # Densities of a wrong model are too sure: one slope and shift fitted to the labels.
    far = model.difference(x)
    scale = np.abs(far).mean() or 1.0
    beta = logistic(np.stack([np.clip(far / scale, -4, 4), np.ones(len(far))], axis=1), y, ridge=1.0)
    model.slope, model.shift = float(beta[0] / scale), float(beta[1])
    return model


def _each(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        column = bw.strings(batch.column(at))
        for lo, hi in bw.slices(column):
            yield batch.slice(lo, hi - lo), statistics(column.slice(lo, hi - lo))


def fit(documents: DataFrame, labels: DataFrame, column: str = "quality") -> Discriminant | Constant:
    """Model of labelled training rows (a bounded sample); only their statistics reach the driver."""
    sample = training_sample(documents, labels, column, {1: SAMPLE_GOOD, 0: SAMPLE_BAD})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _each(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    got = sample.select("text", "y").mapInArrow(run, "x array<double>, y int").toArrow()
    scratch.discard(sample)
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(STATISTICS))
    return discriminant(x, got.column("y").to_numpy())


def score(documents: DataFrame, model: Discriminant | Constant, text: str = "text") -> DataFrame:
    """All columns of ``documents`` and ``score`` (0 to 1, higher: better).  Null and empty
    texts and texts without words have statistics 0.  Whole texts; no shuffle.  The added
    column replaces any of the same name."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    base = documents.drop("score")
    at = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _each(batches, at):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.score(x))],
                                             names=[*batch.schema.names, "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields), "score double"])
    return base.mapInArrow(run, schema)
