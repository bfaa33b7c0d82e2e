"""Operator 6: clauses by a plain scorer, and the order of the patterns' weights."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import bytewords as bw
from lodestar.llm import toxicity as tox

WORD = re.compile(r'"|[0-9A-Za-z\x80-\U0010ffff]+')
LISTS = {k: set(v.split()) for k, v in tox.CLOSED.items()}


def plain(text, families):
    """Pattern of every clause by reading its words one after the other."""
    out = []
    for clause in re.split(r"[.!?;:\n]", text):
        insults, threats, target, intent, negator, quoted, report = [], [], False, False, -9, False, False
        place = 0
        # Marks before the first word: only one that stands right before it opens a quotation.
        lead = re.match(r"[^0-9A-Za-z\x80-\U0010ffff]*", clause).group()
        clause = ('"' if lead.endswith('"') else "") + clause[len(lead):]
        for m in WORD.finditer(clause):
            w = m.group().lower()
            if w == '"':
                report, quoted = False, not quoted
                continue
            place += 1
            kind = "reported" if quoted or report else "negated" if place - negator <= 3 else "own"
            if any(w.startswith(f) for f in families):
                insults.append(kind)
            elif w in LISTS[tox.HARM]:
                if intent:
                    threats.append(kind)
            elif w in LISTS[tox.INTENT]:
                intent = True
            elif w in LISTS[tox.TARGET]:
                target = True
            elif w in LISTS[tox.NEGATOR]:
                negator = place
            elif w in LISTS[tox.REPORT] and not quoted:
                report = True
        found, name = (insults, "insult") if insults else (threats, "threat")
        if found:
            best = max(found, key=["negated", "reported", "own"].index)
            out.append(f"{name}{' at a target' * target}" if best == "own" else f"{best} {name}")
    return out


def test_clauses_like_the_plain_scorer():
    rnd = random.Random(6)
    words = ["idiot", "idiots", "scum", "kill", "hurt", "will", "you", "they", "not", "never", "said", '"', "the", "a", "x1", "é", ".", ";", "\n", "was"]
    g = tox.grammar({"idiot": 3.0, "scum": 2.0})
    for _ in range(3000):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 14))) + " end"
        text = text.replace('" ', rnd.choice(['" ', '"']))
        got = [tox.PATTERNS[p] for p, *_ in tox.clauses(bw.strings(pa.array([text])), g)[0]]
        assert got == plain(text, ("idiot", "scum")), text


def fitted(rows):
    """Weights from (texts, label) rows."""
    g = tox.grammar({"idiot": 3.0})
    x = tox.features([c for t, _ in rows for c in tox.clauses(bw.strings(pa.array([t])), g)])
    return tox.grammar({"idiot": 3.0}, tox.pattern_weights(x, np.array([y for _, y in rows])))


def score(g, text):
    return float(tox.probability(tox.features(tox.clauses(bw.strings(pa.array([text])), g)), g.weights)[0])


@pytest.mark.parametrize("rows", [
    [("you are an idiot", 1)] * 40 + [("a fine day", 0)] * 200 + [("he is not an idiot", 1)] * 20,        # labels that say otherwise
    [("you are an idiot", 1)] * 40 + [("a fine day", 0)] * 200,
    [("what an idiot", 1)] * 30 + [("she said he is an idiot", 1)] * 60 + [("a fine day", 0)] * 200])
def test_negation_and_report_lower_and_threats_raise_the_score(rows):
    g = fitted(rows)
    clean = score(g, "a fine day")
    assert score(g, "you are an idiot") >= score(g, "what an idiot") > 0.5
    for weaker in ("he is not an idiot", "she said he is an idiot", 'he wrote "idiot" there'):
        assert clean <= score(g, weaker) < score(g, "what an idiot")
    one, two = score(g, "I will kill you"), score(g, "I will kill you. I will beat you")
    assert clean < score(g, "I will hurt dogs") <= one < two and two > 0.5
    assert score(g, "I will not kill you") <= one and score(g, "he said I will kill you") < one


def test_thinned_classes_stand_for_their_rows():
    """Rows that stand for several weigh as if they were repeated."""
    rng = np.random.default_rng(3)
    x = np.hstack([rng.random((200, len(tox.PATTERNS))), np.ones((200, 1))])
    y = (x[:, 1] + 0.3 * rng.random(200) > 0.7).astype(int)
    stands = np.where(y == 1, 1.0, 5.0)
    many = np.repeat(np.arange(200), stands.astype(int))
    assert np.allclose(tox.pattern_weights(x, y, stands), tox.pattern_weights(x[many], y[many]), atol=1e-3)
