"""BPE by dynamic programming over prefixes (operator 3).

For every prefix of a word the last token of its BPE encoding is unique.  It is
found among the vocabulary entries that are suffixes of the prefix (one pass of
an automaton with suffix links over the vocabulary reports them all), as the one
token that is *compatible* with the last token of the prefix before it.  The
back-pointers from the end of the word then give the exact ids, without running
merges.

Pair compatibility.  BPE merges in order of rank, and a merge only joins entries
of lower rank, so a token on its own is built along its merge tree.  Two
neighbours ``s t`` stay apart unless, at some moment, the entry ``a`` at the right
edge of ``s`` and ``b`` at the left edge of ``t`` are both there and ``(a, b)`` is merged
before either is used up inside its own token: rank(a, b) below the rank that uses
``a``, and not above the rank that uses ``b`` (of equal merges the left one goes first).
The right edges of a token are the right children down its merge tree.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import scratch
from lodestar.llm.bitpack import byte_chars

LONGEST = 256               # characters of a piece or word that is remembered, at most
END = "\ue000"              # stands for the word-end mark inside the automaton
NEVER = 1 << 60
# Below this code point the library's Unicode tables and Python's agree.
PLAIN = regex.compile(r"[\u0021-\u036f]*")
# Python's split() takes these for white space, the library's \s doesn't.
ODD_SPACE = re.compile("[\x1c-\x1f]")


class PrefixBPE(dict):
    """Exact encoder of a BPE tokenizer file with word ends; remembers the ids
    (little-endian u32 bytes) of at most ``limit`` white-space-separated pieces and
    as many words, each in two generations: a full memo becomes the old one, from which what is
    used again comes back, so that frequent words are never encoded anew.  Pieces and words of more
    than ``LONGEST`` characters are not remembered, which bounds the memos in bytes too."""

    def __init__(self, path: str, limit: int = 300_000):
        from tokenizers import Tokenizer
        super().__init__()
        self.limit = limit
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.tok = Tokenizer.from_file(path)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

        self.rank: dict[tuple[int, int], int] = {}
        children: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(model["merges"]):
            made, pair = vocab[a + b], (vocab[a], vocab[b])
            self.rank[pair] = r
            children.setdefault(made, (*pair, r))
        self.children, self.edges = children, {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            if not self.single(i):      # no text encodes to it
                continue
            s = t[: -len(suffix)] + END if suffix and t.endswith(suffix) and len(t) > len(suffix) else t
            self.automaton.add_word(s, (i, len(s)))
        self.automaton.make_automaton()

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """``(entry, rank of the merge that uses it)`` from the token inwards."""
        got = self.edges.get((token, side))
        if got is None:
            got, at, used = [(token, NEVER)], token, NEVER
            while at in self.children:
                *pair, used = self.children[at]
                at = pair[side]
                got.append((at, used))
            self.edges[token, side] = got
        return got

    def compatible(self, s: int, t: int) -> bool:
        rank, right, got = self.rank.get, self.edge(s, 1), True
        for b, used_b in self.edge(t, 0):
            for a, used_a in right:
                r = rank((a, b))
                if r is not None and r < used_a and r <= used_b:
                    got = False
        if len(self.pairs) >= 300_000:
            self.pairs.clear()
        self.pairs[s, t] = got
        return got

    def single(self, token: int) -> bool:
        """Whether the token's own symbols encode to the token."""
        got = self.whole.get(token)
        if got is None:
            made = self.children.get(token)
            got = made is None or (self.single(made[0]) and self.single(made[1])
                                   and self.joins(made[0], made[1], made[2]))
            self.whole[token] = got
        return got

    def joins(self, s: int, t: int, r: int) -> bool:
        """Whether ``s t`` are whole when their own merge ``r`` comes."""
        rank, right = self.rank.get, self.edge(s, 1)
        for b, used_b in self.edge(t, 0):
            for a, used_a in right:
                q = rank((a, b))
                if q is not None and (a, b) != (s, t) and q < used_a and q <= used_b and q < r:
                    return False
        return True

    def word(self, chars: str) -> list[int]:
        """Ids of one pre-token, given in byte characters."""
        n = len(chars) + 1
        tokens, starts = [-1] * (n + 1), [0] * (n + 1)      # by prefix length
        known, last = self.pairs, n - 1
        for end, (token, size) in self.automaton.iter(chars + END):
            end += 1
            if tokens[end] >= 0 or end == last:     # the last symbol carries the end mark
                continue
            start = end - size
            if start:
                before = tokens[start]
                if before < 0:
                    continue
                fits = known.get((before, token))
                if fits is None:
                    fits = self.compatible(before, token)
                if not fits:
                    continue
            tokens[end], starts[end] = token, start
        ids, at = [], n
        while at:
            ids.append(tokens[at])
            at = starts[at]
        ids.reverse()
        return ids

    def forget(self) -> None:
        """Drops all that texts have added; the tables of the file stay."""
        self.clear()
        self.old_pieces, self.words, self.old_words, self.pairs, self.edges = {}, {}, {}, {}, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.old_pieces = dict(self)
            self.clear()
        value = self.old_pieces.get(piece)
        if value is None:
            if piece.isascii() and piece.isprintable():     # every character is its own byte character
                low = piece.lower()
                value = self.known_word(low) if low.isalpha() else b"".join(map(self.known_word, self.pattern.findall(low)))
            elif PLAIN.fullmatch(piece):
                value = b"".join([self.known_word(byte_chars(w)) for w in self.pattern.findall(unicodedata.normalize("NFC", piece).lower())])
            else:
                value = b"".join(map(self.known_word, self.split_by_library(piece)))
        if len(piece) <= LONGEST:
            self[piece] = value
        return value

    def known_word(self, chars: str) -> bytes:
        got = self.words.get(chars)
        if got is None:
            if len(self.words) >= self.limit:
                self.old_words, self.words = self.words, {}
            got = self.old_words.get(chars)
            if got is None:
                ids = self.word(chars)
                got = pack(f"<{len(ids)}I", *ids)
            if len(chars) <= LONGEST:
                self.words[chars] = got
        return got

    def split_by_library(self, text: str) -> list[str]:
        return [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(text))]

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if self.cut and any(s in text for s in self.special):
            parts = [np.array([self.special[p]], "<u4") if p in self.special else self.encode(p)
                     for p in self.cut.split(text)]
            return np.concatenate(parts)
        if ODD_SPACE.search(text):
            return np.frombuffer(b"".join(map(self.known_word, self.split_by_library(text))), "<u4")
        return np.frombuffer(b"".join(map(self.__getitem__, text.split())), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The file names no decoder: tokens joined by blanks, marks kept."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(1)
def worker_encoder(tokenizer: str) -> PrefixBPE:
    """One encoder per Python worker: its tables serve all tasks that the worker runs.  A task
    empties the memos when it ends, since the worker goes on to stages that do not encode."""
    return PrefixBPE(scratch.tokenizer_file(tokenizer))


def encode_decode(df: DataFrame, text: str = "text", tokenizer: str = "word_bpe_49k.json",
                  keep: tuple[str, ...] = ("doc_id",), ids_column: str = "ids",
                  decoded_column: str = "decoded") -> DataFrame:
    """Columns ``keep`` plus the exact ids (array<int>) and their decoded text.

    Works on each row alone (no shuffle); null and empty texts have no ids
    and decode to the empty text; texts of any length are whole.
    """
    name = tokenizer
    fields = [f for f in df.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_encoder(name)
        for batch in batches:
            texts, start = batch.column(len(batch.columns) - 1), 0
            while start < len(texts):
                ids, decoded, held, stop = [], [], 0, start
                while stop < len(texts) and held < 500_000:      # bounded output batches
                    got = bpe.encode(texts[stop].as_py())
                    ids.append(got)
                    decoded.append(bpe.decode(got))
                    held += len(got)
                    stop += 1
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(start, stop - start) for c in batch.columns[:-1]]
                    + [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(decoded, pa.string())],
                    names=[*batch.schema.names[:-1], ids_column, decoded_column])
                start = stop
        bpe.forget()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields),
                        f"`{ids_column}` array<int>", f"`{decoded_column}` string"])
    return df.select(*[f.name for f in fields], F.col(text).alias("__text")).mapInArrow(run, schema)
