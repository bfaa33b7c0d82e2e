"""Scalar text expressions (F1-F6, S7, S8, P8, P17, P18), all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop-word list used by the stop-word variant of the
# similarity search (contractions never match after tokenising, kept as given).
STOP_WORDS = [
    'a', 'about', 'above', 'after', 'again', 'against', 'ain', 'all', 'am', 'an', 'and', 'any', 'are',
    'aren', "aren't", 'as', 'at', 'be', 'because', 'been', 'before', 'being', 'below', 'between', 'both',
    'but', 'by', 'can', 'couldn', "couldn't", 'd', 'did', 'didn', "didn't", 'do', 'does', 'doesn',
    "doesn't", 'doing', 'don', "don't", 'down', 'during', 'each', 'few', 'for', 'from', 'further', 'had',
    'hadn', "hadn't", 'has', 'hasn', "hasn't", 'have', 'haven', "haven't", 'having', 'he', 'her', 'here',
    'hers', 'herself', 'him', 'himself', 'his', 'how', 'i', 'if', 'in', 'into', 'is', 'isn', "isn't", 'it',
    "it's", 'its', 'itself', 'just', 'll', 'm', 'ma', 'me', 'mightn', "mightn't", 'more', 'most', 'mustn',
    "mustn't", 'my', 'myself', 'needn', "needn't", 'no', 'nor', 'not', 'now', 'o', 'of', 'off', 'on',
    'once', 'only', 'or', 'other', 'our', 'ours', 'ourselves', 'out', 'over', 'own', 're', 's', 'same',
    'shan', "shan't", 'she', "she's", 'should', "should've", 'shouldn', "shouldn't", 'so', 'some', 'such',
    't', 'than', 'that', "that'll", 'the', 'their', 'theirs', 'them', 'themselves', 'then', 'there',
    'these', 'they', 'this', 'those', 'through', 'to', 'too', 'under', 'until', 'up', 've', 'very', 'was',
    'wasn', "wasn't", 'we', 'were', 'weren', "weren't", 'what', 'when', 'where', 'which', 'while', 'who',
    'whom', 'why', 'will', 'with', 'won', "won't", 'wouldn', "wouldn't", 'y', 'you', "you'd", "you'll",
    "you're", "you've", 'your', 'yours', 'yourself', 'yourselves',
]

# Word pattern and document tag markers.
WORD_PATTERN = "[a-zA-Z]+"
NON_WORD_PATTERN = "[^a-zA-Z]+"
ID_MARK = 'id="'
URL_MARK = '" url='
BODY_MARK = '">'
CLOSE_TAG_LEN = 6  # len('</doc>')


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """every maximal run of ASCII letters, lower-cased.

    Non-letters (including non-ASCII letters) become one space, the rest is
    lower-cased and split; only ASCII letters are left when ``lower`` runs, so
    no non-ASCII capital can turn into an ASCII letter.  All three functions
    are code-generated (no per-element lambda).  A text without letters gives
    ``['']``; consumers drop empty tokens.
    """
    cleaned = F.trim(F.lower(F.regexp_replace(_c(text), NON_WORD_PATTERN, " ")))
    return F.split(cleaned, " ")


def tag_id(line, skip: int = 0) -> Column:
    """The id between the first ``id="`` and the first ``" url=``.

    ``skip`` drops that many further leading characters (S8 uses 14).
    """
    v = _c(line)
    start = F.instr(v, ID_MARK) + F.lit(len(ID_MARK) + skip)
    end = F.instr(v, URL_MARK)
    return v.substr(start, F.greatest(end - start, F.lit(0)))


def tag_body(line) -> Column:
    """The text after the first ``">`` minus the closing ``</doc>``."""
    v = _c(line)
    start = F.instr(v, BODY_MARK) + F.lit(len(BODY_MARK))
    length = F.length(v) - start + F.lit(1) - F.lit(CLOSE_TAG_LEN)
    return v.substr(start, F.greatest(length, F.lit(0)))


def is_tagged_line(line) -> Column:
    """P8 plus the markers the parse needs (lines without them are dropped)."""
    v = _c(line)
    return (v.contains("id") & v.contains("url=") & (F.instr(v, ID_MARK) > 0)
            & (F.instr(v, URL_MARK) > 0) & (F.instr(v, BODY_MARK) > 0))


def prefix_label(c, pattern: str = "^AU") -> Column:
    """1 when the value matches the regex prefix, else 0."""
    return F.when(_c(c).rlike(pattern), F.lit(1)).otherwise(F.lit(0))


def group_of(c, sep: str = "/") -> Column:
    """The part of an id before the first separator."""
    return F.substring_index(_c(c), sep, 1)


def split_bar(c) -> Column:
    """split on ``|`` (built-in, no Python UDF)."""
    return F.split(_c(c), r"\|")


def join_positions(doc_id, positions) -> Column:
    """``doc_id,p1,p2,...`` line for a sorted array of positions."""
    return F.concat_ws(",", _c(doc_id).cast("string"),
                       F.transform(_c(positions), lambda p: p.cast("string")))
