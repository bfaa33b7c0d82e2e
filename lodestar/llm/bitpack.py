"""Token ids in fixed-width bit-packed files (operator 2).

One *file* is a self-contained byte string (little-endian):

    magic ``LSBP`` | u32 version | u32 bits | u32 ids per block
    u64 documents | u64 ids | u64 blocks
    u64 document key      x documents   (ascending)
    u64 first id          x documents + 1 (offsets of the documents in this file)
    u64 block offset      x blocks + 1  (bytes from the start of the payload)
    payload: every block holds ``ids per block`` ids of ``bits`` bits each in
    64-bit words (the last block is padded with zeros)

``bits`` is the minimum for the vocabulary.  A block starts at its own offset,
so any id range is read by unpacking the blocks that cover it, with one
vectorised numpy pass.  Files travel as rows of a Parquet table (one binary value per
file), because only Spark's writers commit atomically on every store; the
bytes can be exported as they are.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm import bytewords as bw
from lodestar.llm import scratch

MAGIC, VERSION = b"LSBP", 1
BLOCK_IDS = 4096            # ids per block, a multiple of 64
FILE_IDS = 1 << 20          # a file is closed when it holds this many ids
SLICE_BYTES = 1 << 20       # text that is cut and encoded at once (one longer text stands alone)

NULL_KEY = -(1 << 63)       # stands for a null document key

_HEAD = struct.Struct("<4sIIIQQQ")


def bits_for(vocabulary: int) -> int:
    """Least width that can hold every id of a vocabulary of that size."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_words(ids: np.ndarray, bits: int) -> np.ndarray:
    """64 ids fill exactly ``bits`` words of 64 bits; len(ids) % 64 == 0."""
    rows = np.ascontiguousarray(ids.astype(np.uint64).reshape(-1, 64).T)
    out = np.zeros((bits, rows.shape[1]), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[word] |= rows[j] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= rows[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).reshape(-1)


def unpack_words(words: np.ndarray, bits: int) -> np.ndarray:
    cols = np.ascontiguousarray(words.reshape(-1, bits).T)
    out = np.empty((64, cols.shape[1]), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        v = cols[word] >> np.uint64(shift)
        if shift + bits > 64:
            v = v | (cols[word + 1] << np.uint64(64 - shift))
        out[j] = v & mask
    return np.ascontiguousarray(out.T).reshape(-1)


def pack_file(keys: list[int], lengths: list[int], ids: np.ndarray, bits: int,
              block_ids: int = BLOCK_IDS) -> bytes:
    """File bytes of the documents ``keys`` whose ids are concatenated in ``ids``."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError("an id does not fit the width")
    blocks = -(-len(ids) // block_ids)
    padded = np.zeros(blocks * block_ids, np.uint32)
    padded[: len(ids)] = ids
    payload = pack_words(padded, bits)
    block_bytes = block_ids * bits // 8
    first = np.zeros(len(keys) + 1, "<u8")
    np.cumsum(lengths, out=first[1:])
    return b"".join([
        _HEAD.pack(MAGIC, VERSION, bits, block_ids, len(keys), len(ids), blocks),
        np.array(keys, "<i8").tobytes(), first.tobytes(),
        (np.arange(blocks + 1, dtype="<u8") * block_bytes).tobytes(),
        payload.astype("<u8").tobytes()])


class PackedFile:
    """Random access to the documents of one file."""

    def __init__(self, data: bytes):
        magic, version, self.bits, self.block_ids, n, self.n_ids, blocks = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a bit-packed id file")
        at = _HEAD.size
        self.keys = np.frombuffer(data, "<i8", n, at)
        self.first = np.frombuffer(data, "<u8", n + 1, at + 8 * n).astype(np.int64)
        at += 16 * n + 8
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        self.payload = memoryview(data)[at + 8 * (blocks + 1):]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of the file: only the blocks that cover them are read."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // self.block_ids, -(-stop // self.block_ids)
        words = np.frombuffer(self.payload[self.offsets[a]:self.offsets[b]], "<u8")
        got = unpack_words(words, self.bits)
        return got[start - a * self.block_ids: stop - a * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.first[i]), int(self.first[i + 1]))


# --- encoding with the tokenizers library ---------------------------------

# The byte-level alphabet (printable bytes stand for themselves,
# the others for code points from 256 on) and the pre-tokenizer's pattern.
_PRINT = [*range(33, 127), *range(161, 173), *range(174, 256)]
_REST = [b for b in range(256) if b not in set(_PRINT)]
BYTE_TO_CHAR = {b: b for b in _PRINT} | {b: 256 + i for i, b in enumerate(_REST)}
PRE_TOKENS = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_ODD_BYTE = np.zeros(256, bool)             # white space and NUL other than blank and line break
_ODD_BYTE[[0, *map(ord, _OTHER_SPACE)]] = True
_KIND = np.full(256, 3, np.uint8)           # of ASCII characters: 0 white space, 1 letter, 2 digit, 3 other
_KIND[[0x20, 0x0A]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x30:0x3A] = 2
# Below this code point the library's Unicode tables and Python's agree.
PLAIN = regex.compile(r"[\u0000-\u036f]*")


def byte_chars(text: str) -> str:
    return text.encode("utf-8").decode("latin-1").translate(BYTE_TO_CHAR)


class ByteLevelEncoder(dict):
    """Whole-text ids of a byte-level BPE tokenizer as little-endian u32 bytes.

    A text in which no two white-space characters are adjacent is cut before
    every blank and around every line break, and where ASCII letters, digits and other marks
    meet; no pre-token crosses such a cut, so each distinct piece is encoded once (memos of at
    most ``limit`` pieces in each of two generations and as many pre-tokens).  Any other text, and any text
    that may hold a special token, goes to the library whole.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer
        super().__init__()
        self.tok, self.limit = Tokenizer.from_file(path), limit
        self.model, self.known, self.old = self.tok.model, {}, {}
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]

    def library(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:         # the pieces in use come back from the older generation
            self.old = dict(self)
            self.clear()
        value = self.old.get(piece)
        if value is None:
            if piece.isascii() and piece.isprintable() and "'" not in piece:
                # One pre-token, whose only character that isn't its own byte character is the blank.
                value = array("I", [t.id for t in self.model.tokenize(piece.replace(" ", "\u0120"))]).tobytes()
            elif PLAIN.fullmatch(piece):
                value = b"".join(map(self.pre_token, PRE_TOKENS.findall(piece)))
            else:
                value = self.library(piece)
        self[piece] = value
        return value

    def pre_token(self, pre: str) -> bytes:
        got = self.known.get(pre)
        if got is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            got = self.known[pre] = array("I", [t.id for t in self.model.tokenize(byte_chars(pre))]).tobytes()
        return got

    def whole_rows(self, column: pa.Array, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Rows that go to the library whole: with adjacent white space, white space other than blanks
        and line breaks, or a special token."""
        blank = (data == 0x20) | (data == 0x0A)
        at = np.flatnonzero(blank[1:] & blank[:-1])
        row = lambda x: np.searchsorted(offs, x, "right") - 1
        bad = np.zeros(len(column), bool)
        bad[row(at)[row(at) == row(at + 1)]] = True
        bad[row(np.flatnonzero(_ODD_BYTE[data]))] = True
        for lead in (0xC2, 0xE1, 0xE2, 0xE3):           # white space beyond ASCII
            at = np.flatnonzero(data == lead)
            b, c = data[np.minimum(at + 1, len(data) - 1)], data[np.minimum(at + 2, len(data) - 1)]
            space = {0xC2: (b == 0x85) | (b == 0xA0), 0xE1: (b == 0x9A) & (c == 0x80), 0xE3: (b == 0x80) & (c == 0x80),
                     0xE2: (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F)}[lead]
            bad[row(at[space])] = True
        for token in self.special:
            bad |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        return bad

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a string column without nulls, one after the other, and ids per row.
        The whole column is cut at once, each distinct piece of it is encoded once, and the
        ids are gathered by offsets."""
        offs = bw.offsets_of(column)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offs[0]: offs[-1]] if raw is not None else np.zeros(0, np.uint8)
        offs = offs - offs[0]
        counts = np.zeros(len(column), np.int64)
        if not len(data):
            return np.zeros(0, np.uint32), counts
        bad = self.whole_rows(column, data, offs)
        starts = np.zeros(len(data) + 1, bool)
        starts[offs[:-1]] = True
        starts[:-1] |= (data == 0x20) | (data == 0x0A)
        starts[1:] |= data == 0x0A
        # Inside a piece, ASCII letters, digits and other marks are pre-tokens of their own, but for
        # contractions and what stands beside characters beyond ASCII.
        kind = _KIND[data]
        inner = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)) + 1
        cuts = np.flatnonzero(starts[:-1])
        odd = np.append(0, np.cumsum((data == 0x27) | (data >= 0x80)))
        piece = np.searchsorted(cuts, inner, "right") - 1
        starts[inner[odd[np.append(cuts, len(data))[piece + 1]] == odd[cuts[piece]]]] = True
        cuts = np.flatnonzero(starts[:-1])
        owner = np.searchsorted(offs, cuts, "right") - 1
        pieces = pa.Array.from_buffers(pa.string(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(data)).astype(np.int32)), pa.py_buffer(data)])
        if bad.any():
            kept = ~bad[owner]
            pieces, owner = pieces.filter(pa.array(kept)), owner[kept]
        coded = pieces.dictionary_encode()
        which = coded.indices.to_numpy()
        known = [self[x] for x in coded.dictionary.to_pylist()]
        size = np.array([len(x) // 4 for x in known], np.int64)
        flat, first = np.frombuffer(b"".join(known), "<u4"), np.cumsum(size) - size
        n = size[which]
        ends = np.cumsum(n)
        ids = flat[np.repeat(first[which] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        counts += np.bincount(owner, n, len(column)).astype(np.int64)
        if not bad.any():
            return ids, counts
        parts, at = [], 0
        for i in np.flatnonzero(bad):
            upto = at + counts[:i].sum() - sum(len(p) for p in parts)
            whole = np.frombuffer(self.library(column[i].as_py()), "<u4")
            parts += [ids[at:upto], whole]
            at, counts[i] = upto, len(whole)
        return np.concatenate([*parts, ids[at:]]), counts

    def encode(self, text: str | None) -> bytes:
        return self.encode_column(pa.array([text or ""], pa.string()))[0].astype("<u4").tobytes()


@lru_cache(2)
def encoder(tokenizer: str) -> ByteLevelEncoder:
    """One encoder per Python worker, so that later tasks find the pieces of earlier ones."""
    return ByteLevelEncoder(scratch.tokenizer_file(tokenizer))


def write_packed(df: DataFrame, text: str = "text", key: str = "doc_id",
                 tokenizer: str = "byte_bpe_50k.json", end_id: int = 0,
                 vocabulary: int | None = None, name: str = "packed-ids") -> DataFrame:
    """Encode every text and write bit-packed files in ascending ``key`` order.

    Returns the written table: ``part int, file int, n_docs long, n_ids long,
    payload binary``; (part, file) ascending is key order.  Rows are dealt by key
    ranges, so the order needs no global sort; a file holds about FILE_IDS ids.
    Null texts count as empty (only the end id).  Rows with equal keys keep
    an order by a hash of the text; null keys come first and are stored as NULL_KEY.
    """
    spark = df.sparkSession
    if vocabulary is None:
        from tokenizers import Tokenizer
        vocabulary = max(Tokenizer.from_file(scratch.tokenizer_file(tokenizer)).get_vocab_size(), end_id + 1)
    bits = bits_for(vocabulary)
    path_name = tokenizer

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = encoder(path_name)
        keys, lengths, chunks, held, file_no = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(chunks)
            data = pack_file(keys, lengths, ids, bits)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": pa.array([file_no], pa.int32()),
                "n_docs": pa.array([len(keys)], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()),
                "payload": pa.array([data], pa.binary())})

        for batch in batches:
            column = bw.strings(batch.column(1))
            for lo, hi in bw.slices(column, SLICE_BYTES):
                ids, counts = enc.encode_column(column.slice(lo, hi - lo))
                # The end id behind every document.
                ended = np.full(len(ids) + len(counts), end_id, np.uint32)
                ended[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
                counts = counts + 1
                upto = np.cumsum(counts)
                new = [NULL_KEY if k is None else k for k in batch.column(0).slice(lo, hi - lo).to_pylist()]
                i, at = 0, 0
                while i < len(new):
                    # Documents up to the one that fills the file.
                    j = min(int(np.searchsorted(upto, at + FILE_IDS - held)) + 1, len(new))
                    keys += new[i:j]
                    lengths += counts[i:j].tolist()
                    chunks.append(ended[at: upto[j - 1]])
                    held += int(upto[j - 1]) - at
                    i, at = j, int(upto[j - 1])
                    if held >= FILE_IDS:
                        yield close()
                        keys, lengths, chunks, held, file_no = [], [], [], 0, file_no + 1
        if keys:
            yield close()

    # Ranges of keys alone would put rows without a key, or of one key, into one task.
    ordered = (df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).withColumn("h", F.xxhash64("t"))
               .repartitionByRange("k", "h").sortWithinPartitions("k", "h", "t").select("k", "t"))
    files = ordered.mapInArrow(encode, "part int, file int, n_docs long, n_ids long, payload binary")
    return scratch.stage(files, name)


def read_packed(files: DataFrame) -> DataFrame:
    """Read the files back: ``key long, start long, n_tokens long, ids_crc32 long``.

    ``start`` counts the ids of all documents before; it is the sum of the
    parts before (one row per part), of the files before in the part and
    of the documents before in the file.
    """
    from pyspark.sql import Window
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part_start = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    file_start = files.select("part", "file", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0)).alias("file_start"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, no, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                f = PackedFile(data.as_py())
                ids = f.ids(0, f.n_ids).astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(f.first[:-1], f.first[1:], strict=True)]
                n = len(f.keys)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part.as_py()] * n, pa.int32()), "file": pa.array([no.as_py()] * n, pa.int32()),
                    "key": pa.array(f.keys, pa.int64()), "first": pa.array(f.first[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(f.first), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    docs = files.select("part", "file", "payload").mapInArrow(
        unpack, "part int, file int, key long, first long, n_tokens long, ids_crc32 long")
    return (docs.join(file_start, ["part", "file"]).join(part_start, "part")
            .select(F.when(F.col("key") != NULL_KEY, F.col("key")).alias("key"),
                    (F.col("part_start") + F.col("file_start") + F.col("first")).alias("start"),
                    "n_tokens", "ids_crc32"))
