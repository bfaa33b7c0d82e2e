"""Toxicity by a weighted finite-state grammar of clauses (operator 6).

Words are read as symbols by a lexicon transducer: insults (families of words with
a common beginning, learned from labels) and closed lists of harm verbs, intent,
targets, negators and report verbs; quotation marks are symbols too.  Small machines
for insult, threat, target, negation and reported speech are composed into one
deterministic machine.  It runs over every clause that has an insult or a harm word
and names the clause's pattern; a clause weighs as much as its strongest insult.  A
text's score is a logistic function of its matched clauses by pattern, so an isolated word
counts only through its clause.  The patterns' weights are fitted to labels around prior ones, so
that patterns which no label shows (threats, say) still count, and keep an order: negated and
reported clauses weigh at most half of the own ones, a target or an own threat never lowers a score.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import bytewords as bw
from lodestar.llm import scratch

SAMPLE_TOXIC, SAMPLE_CLEAN = 8000, 12000    # labelled texts that the model is fitted on, about
STEMS = range(3, 9)                         # characters of the word beginnings that are tried
CANDIDATES = 300_000                        # beginnings counted in the clean texts, the most frequent ones
PRECISION = 0.9                             # of an insult family among the labelled texts
CLEAN_COST = 5                              # toxic texts that a clean text with the family outweighs
PURER = 0.98                                # of one that no text needs for its explanation

OTHER, INSULT, HARM, INTENT, TARGET, NEGATOR, REPORT, QUOTE = range(8)

# Closed word lists (fixed values).
CLOSED = {
    HARM: "kill hurt destroy murder beat stab shoot smash crush strangle attack töten schlagen verletzen tuer frapper blesser "
          "matar golpear herir",
    INTENT: "will ll gonna going shall must should hope werde werden soll vais va doit voy vas debe",
    TARGET: "you your yours yourself u ur they them their he him his she her these those people du dich dir dein ihr euch sie tu te "
            "toi vous ils elles usted ustedes ellos ellas ti",
    NEGATOR: "not no never neither nor cannot cant dont doesnt isnt arent nicht kein keine nie ne pas jamais nunca tampoco",
    REPORT: "said says say claimed claims wrote writes quoted called reported according sagte sagt dit disait dijo dice",
}


# --- machines ------------------------------------------------------------------

def _insult(state: int, symbol: int, negated: bool, reported: bool) -> int:
    """0 none, 1 only negated insults, 2 a reported one, 3 an own one."""
    return max(state, 2 if reported else 1 if negated else 3) if symbol == INSULT else state


def _threat(state: int, symbol: int, negated: bool, reported: bool) -> int:
    """0 none, 1 intent seen, 2 negated threat, 3 reported threat, 4 own threat (harm after intent)."""
    if symbol == INTENT:
        return max(state, 1)
    if symbol == HARM and state:
        return max(state, 3 if reported else 2 if negated else 4)
    return state


def _target(state: int, symbol: int) -> int:
    return 1 if symbol == TARGET else state


def _negation(state: int, symbol: int) -> int:
    """Words for which a negator still holds."""
    return 3 if symbol == NEGATOR else max(0, state - (symbol != QUOTE))


def _reported(state: int, symbol: int) -> int:
    """0 own words, 1 after a report verb, 2 inside a quotation."""
    if symbol == QUOTE:
        return 0 if state == 2 else 2
    return 1 if symbol == REPORT and state == 0 else state


PATTERNS = ("none", "insult", "insult at a target", "negated insult", "reported insult", "threat", "threat at a target",
            "negated threat", "reported threat")

OWN = (1, 2, 5, 6)
# Prior weights of log(1 + summed clause weight) by pattern; place 0 belongs to all own clauses together.
PRIOR = np.array([1.0, 1.0, 1.5, 0.2, 0.2, 1.5, 2.5, 0.0, 0.2])
PRIOR_ROWS = 5.0            # labelled rows that the prior counts for


def _pattern(insult: int, threat: int, target: int) -> int:
    if insult:
        return (0, 3, 4, 1 + target)[insult]
    return (0, 0, 7, 8, 5 + target)[threat]


def compose() -> tuple[np.ndarray, np.ndarray]:
    """``(next state by state and symbol, pattern by state)`` of the product machine."""
    start = (0, 0, 0, 0, 0)
    known, todo, rows = {start: 0}, [start], []
    while todo:
        i, t, g, n, r = todo.pop(0)
        row = []
        for symbol in range(8):
            after = (_insult(i, symbol, n > 0, r > 0), _threat(t, symbol, n > 0, r > 0), _target(g, symbol), _negation(n, symbol),
                     _reported(r, symbol))
            if after not in known:
                known[after] = len(known)
                todo.append(after)
            row.append(known[after])
        rows.append(row)
    return np.array(rows), np.array([_pattern(i, t, g) for i, t, g, _, _ in known])


NEXT, FINAL = compose()

# Bytes that end a clause.
CLAUSE_END = np.zeros(256, np.int64)
CLAUSE_END[[ord(c) for c in ".!?;:\n"]] = 1


# --- model -----------------------------------------------------------------------

@dataclass
class Grammar:
    """Insult families (byte length -> sorted hashes and weights), closed lists, pattern weights."""

    stems: dict[int, tuple[np.ndarray, np.ndarray]]
    closed: tuple[np.ndarray, np.ndarray]
    weights: np.ndarray         # of the features; the last one is the intercept


def _hash(words: list[str]) -> np.ndarray:
    return bw.scan(bw.strings(pa.array(words, pa.string()))).hashes()


def grammar(families: dict[str, float], weights: np.ndarray | None = None) -> Grammar:
    """Grammar of insult families (beginning -> weight); untrained pattern weights are all alike."""
    by_length: dict[int, list[str]] = {}
    for w in families:
        by_length.setdefault(len(w.encode()), []).append(w)
    stems = {}
    for size, ws in by_length.items():
        h = _hash(ws)
        order = np.argsort(h)
        stems[size] = h[order], np.array([families[w] for w in ws])[order]
    flat = [(w, s) for s, ws in CLOSED.items() for w in ws.split()]
    h = _hash([w for w, _ in flat])
    order = np.argsort(h)
    closed = h[order], np.array([s for _, s in flat])[order]
    if weights is None:
        weights = np.append(np.full(len(PATTERNS), 2.0), -3.0)
    return Grammar(stems, closed, weights)


def clauses(column: pa.Array, g: Grammar) -> list[list[tuple[int, int, int, float]]]:
    """Matched clauses ``(pattern, byte start, byte end, weight)`` of each text."""
    w = bw.scan(column, bw.ALNUM)
    out: list[list] = [[] for _ in range(len(w.counts))]
    if not len(w.start):
        return out
    up, down = bw._powers(len(w.data))
    prefix = np.zeros(len(w.data) + 1, np.uint64)
    np.cumsum(bw._TABLE[w.data] * up[: len(w.data)], out=prefix[1:])

    def hashes(upto, rows):
        return bw.finalise((prefix[upto] - prefix[w.start[rows]]) * down[w.start[rows]])

    def found(sorted_hashes, h):
        at = np.minimum(np.searchsorted(sorted_hashes, h), len(sorted_hashes) - 1)
        return at, sorted_hashes[at] == h

    rows = np.arange(len(w.start))
    at, ok = found(g.closed[0], hashes(w.end, rows))
    symbol = np.where(ok, g.closed[1][at], OTHER)
    weight = np.zeros(len(rows))
    for size, (known, values) in g.stems.items():
        fit = np.flatnonzero(w.end - w.start >= size)
        at, ok = found(known, hashes(w.start[fit] + size, fit))
        fit, at = fit[ok], at[ok]
        symbol[fit] = INSULT
        weight[fit] = np.maximum(weight[fit], values[at])
    trigger = np.flatnonzero((symbol == INSULT) | (symbol == HARM))
    if not len(trigger):
        return out
    offsets = bw.offsets_of(column)
    offsets = offsets - offsets[0]
    ends = np.cumsum(CLAUSE_END[w.data])[w.start]       # clause number, with the text's
    fresh = np.concatenate(([True], (ends[1:] != ends[:-1]) | (w.doc[1:] != w.doc[:-1])))
    clause = np.cumsum(fresh) - 1
    first = np.append(np.flatnonzero(fresh), len(rows))
    marks = np.cumsum(w.data == 0x22)[w.start]
    for c in np.unique(clause[trigger]):
        a, b = first[c], first[c + 1]
        # A quotation that opens right before the clause's first word counts; a mark that closes one
        # behind the sentence before does not.
        opens = w.start[a] > offsets[w.doc[a]] and w.data[w.start[a] - 1] == 0x22
        state, quoted = 0, marks[a] - opens
        for s, m in zip(symbol[a:b].tolist(), marks[a:b].tolist(), strict=True):
            for _ in range(m - quoted):
                state = NEXT[state, QUOTE]
            quoted = m
            state = NEXT[state, s]
        pattern = int(FINAL[state])
        if pattern:
            d = w.doc[a]
            out[d].append((pattern, int(w.start[a] - offsets[d]), int(w.end[b - 1] - offsets[d]), float(weight[a:b].max())))
    return out


def features(found: list[list[tuple]]) -> np.ndarray:
    """By text: log of 1 + the summed clause weights of each pattern, and in place 0 of all own
    insults and threats together (so a pattern that no label showed has a weight); a constant."""
    x = np.zeros((len(found), len(PATTERNS) + 1))
    for i, cs in enumerate(found):
        for pattern, _, _, weight in cs:
            x[i, pattern] += max(weight, 1.0)
            if pattern in OWN:
                x[i, 0] += max(weight, 1.0)
    x = np.log1p(x)
    x[:, -1] = 1
    return x


def probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))


def ordered(beta: np.ndarray) -> np.ndarray:
    """Weights in the grammar's order: nothing below 0, a target adds to an insult and to a
    threat, and negated or reported clauses weigh at most half of the least own one of their kind."""
    w = np.maximum(beta, 0.0)
    w[-1] = beta[-1]
    w[2], w[6] = max(w[1], w[2]), max(w[5], w[6])
    half = lambda own: (w[0] + w[own]) / 2
    w[3], w[4] = min(w[3], half(1)), min(w[4], half(1))
    w[7], w[8] = min(w[7], half(5)), min(w[8], half(5))
    return w


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps (the constant isn't shrunk)."""
    beta = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(rounds):
        p = probability(x, beta)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink + 1e-9), x.T @ (y - p) - shrink * beta)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def pattern_weights(x: np.ndarray, y: np.ndarray, rows: np.ndarray | None = None, rounds: int = 200) -> np.ndarray:
    """Logistic regression of rows that stand for ``rows`` labelled texts each, shrunk towards PRIOR (the
    constant isn't shrunk) and kept in order: Newton steps, each brought back into order, while they
    lower the loss."""
    rows = np.ones(len(y)) if rows is None else rows
    prior = np.append(PRIOR, 0.0)
    shrink = np.append(np.full(len(PRIOR), PRIOR_ROWS), 1e-6)

    def loss(b):
        t = np.clip(x @ b, -40, 40)
        return (rows * (np.logaddexp(0, t) - y * t)).sum() + 0.5 * (shrink * (b - prior) ** 2).sum()

    beta, step = ordered(np.append(PRIOR, -3.0)), 1.0
    now = loss(beta)
    for _ in range(rounds):
        p = probability(x, beta)
        hessian = (x * (rows * p * (1 - p))[:, None]).T @ x + np.diag(shrink + 1e-9)
        move = np.clip(np.linalg.solve(hessian, x.T @ (rows * (y - p)) - shrink * (beta - prior)), -4, 4)
        tried = ordered(beta + step * move)
        if (after := loss(tried)) < now - 1e-9:
            beta, now, step = tried, after, min(1.0, 2 * step)
        elif (step := step / 2) < 1e-4:
            break
    return beta


# --- fitting ---------------------------------------------------------------------

def _words(text: str) -> list[str]:
    w = bw.scan(bw.strings(pa.array([text], pa.string())), bw.ALNUM)
    data = w.data.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(w.start.tolist(), w.end.tolist(), strict=True)]


def _beginnings(text: str) -> set[str]:
    """Distinct beginnings of the words of a text."""
    return {word[:n] for word in set(_words(text)) for n in STEMS if len(word) >= n}


def _in_context(text: str, wanted: set[str]) -> list[tuple[str, int]]:
    """Wanted beginnings with a hash of the words beside each occurrence."""
    words = ["", *_words(text), ""]
    return sorted({(word[:n], zlib.crc32(f"{words[i]} {words[i + 2]}".encode()))
                   for i, word in enumerate(words[1:-1]) for n in STEMS if len(word) >= n and word[:n] in wanted})


def cover(toxic: list[list[tuple[str, int]]], counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Insult families from the toxic texts' candidate beginnings with their contexts.

    First by sequential covering: always the beginning that is in most of the texts not
    yet explained, each clean text with it counting against it (of equal ones the longest),
    while it explains enough.  Then the others that are
    purer still and stand in many different contexts: a real insult does, even if its texts hold
    others too, while the rare words of a much copied toxic text don't."""
    least, contexts_least = max(3, n_toxic // 500), max(8, n_toxic // 100)

    def weight(k: str) -> float:
        t, c = counts[k]
        return math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))

    left = {i: {k for k, _ in keys} for i, keys in enumerate(toxic)}
    gain = Counter(k for keys in left.values() for k in keys)
    holders: dict[str, list[int]] = {}
    contexts: dict[str, set[int]] = {}
    for i, keys in enumerate(toxic):
        for k in left[i]:
            holders.setdefault(k, []).append(i)
        for k, c in keys:
            contexts.setdefault(k, set()).add(c)
    families = {}
    while gain:
        best = max(gain, key=lambda k: (gain[k] - CLEAN_COST * counts[k][1], len(k), k))
        if gain[best] - CLEAN_COST * counts[best][1] < least:
            break
        families[best] = weight(best)
        for i in holders[best]:
            for k in left.pop(i, ()):
                gain[k] -= 1
        gain = Counter({k: n for k, n in gain.items() if n >= least})
    for k in sorted(holders, key=lambda k: (CLEAN_COST * counts[k][1] - counts[k][0], -len(k), k)):
        t, c = counts[k]
        if t >= PURER * (t + c) and len(contexts[k]) >= contexts_least and not any(k.startswith(f) or f.startswith(k) for f in families):
            families[k] = weight(k)
    return families


def training_sample(documents: DataFrame, labels: DataFrame, column: str, sizes: dict[int, int]) -> DataFrame:
    """``text, y, stands`` of labelled rows (crc32 of the id modulo 5 not 0), each class thinned by a
    hash of the id to about ``sizes[y]`` rows, equal texts once; ``stands`` is the number of labelled
    rows that one stands for.  Written once.  The chosen labels
    are at most about the sum of the sizes, so they go to every task."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
              .where("doc_id is not null and y in (0, 1) and pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 0")
              .groupBy("doc_id").agg(F.max("y").alias("y")))
    n = {r.y: r["count"] for r in chosen.groupBy("y").count().collect()}
    rate = {y: max(1, n.get(y, 0) // sizes[y]) for y in sizes}
    part = F.when(F.col("y") == 1, F.lit(rate[1])).otherwise(F.lit(rate[0]))
    kept = chosen.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), part) == 0)
    found = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(kept), "doc_id").where("text is not null")
             .groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("y").alias("y")))
    stands = F.when(F.col("y") == 1, F.lit(float(rate[1]))).otherwise(F.lit(float(rate[0])))
    return scratch.stage(found.select("text", "y", stands.alias("stands")), "training")


def fit(documents: DataFrame, labels: DataFrame, column: str = "toxic") -> Grammar:
    """Learn the insult families and the weights of the patterns from labelled training rows."""
    sample = training_sample(documents, labels, column, {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN})
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return grammar({})

    def counted(wanted: set | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c: Counter = Counter()
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    keys = _beginnings(text)
                    c.update(keys if wanted is None else keys & wanted.value)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                                             names=["k", "n"])
        return run

    spark = documents.sparkSession
    toxic = sample.where("y = 1").select("text")
    support = max(3, n_toxic // 500)
    often = (toxic.mapInArrow(counted(None), "k string, n long").groupBy("k").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= support).orderBy(F.desc("n"), "k").limit(CANDIDATES).toArrow())
    t = dict(zip(often.column("k").to_pylist(), often.column("n").to_pylist(), strict=True))
    wanted = spark.sparkContext.broadcast(set(t))
    clean = (sample.where("y = 0").select("text").mapInArrow(counted(wanted), "k string, n long")
             .groupBy("k").agg(F.sum("n").alias("n")).toArrow())
    c = dict(zip(clean.column("k").to_pylist(), clean.column("n").to_pylist(), strict=True))
    exact = {k: (n, c.get(k, 0)) for k, n in t.items() if n >= PRECISION * (n + c.get(k, 0))}
    chosen = spark.sparkContext.broadcast(set(exact))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_in_context(x, chosen.value) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([[k for k, _ in x] for x in found], pa.list_(pa.string())),
                                              pa.array([[c for _, c in x] for x in found], pa.list_(pa.int64()))], names=["keys", "beside"])

    got = toxic.mapInArrow(held, "keys array<string>, beside array<long>").toArrow()
    incidence = [list(zip(k, c, strict=True)) for k, c in zip(got.column("keys").to_pylist(), got.column("beside").to_pylist(), strict=True)]
    families = cover(incidence, exact, n_toxic, n_clean)
    model = spark.sparkContext.broadcast(grammar(families))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column_ = bw.strings(batch.column(0))
            for lo, hi in bw.slices(column_):
                x = features(clauses(column_.slice(lo, hi - lo), model.value))
                yield pa.RecordBatch.from_arrays([pa.array(list(x)), *(batch.column(k).slice(lo, hi - lo) for k in (1, 2))],
                                                 names=["x", "y", "stands"])

    got = sample.select("text", "y", "stands").mapInArrow(read, "x array<double>, y int, stands double").toArrow()
    scratch.discard(sample)
    x, y = np.array(got.column("x").to_pylist()), got.column("y").to_numpy()
    return grammar(families, pattern_weights(x, y, got.column("stands").to_numpy()))


def score(documents: DataFrame, model: Grammar, text: str = "text") -> DataFrame:
    """All columns of ``documents``, ``score`` (0 to 1) and ``clauses``: the matched clauses with
    pattern, byte range and weight.  Null and empty texts match nothing and get the score of
    a text without matches.  Added columns replace any of the same names."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    base = documents.drop("score", "clauses")
    at = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = sent.value
        for batch in batches:
            column = bw.strings(batch.column(at))
            for lo, hi in bw.slices(column):
                found = clauses(column.slice(lo, hi - lo), g)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns), pa.array(probability(features(found), g.weights)),
                     pa.array([[{"pattern": PATTERNS[p], "start": a, "end": b, "weight": v} for p, a, b, v in cs] for cs in found],
                              pa.list_(pa.struct([("pattern", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                                  ("weight", pa.float64())])))],
                    names=[*batch.schema.names, "score", "clauses"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields), "score double",
                        "clauses array<struct<pattern: string, start: long, end: long, weight: double>>"])
    return base.mapInArrow(run, schema)
