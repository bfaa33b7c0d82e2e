"""Operators 2 and 3 against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestar.llm import bitpack, prefixbpe, scratch

ODD = ["", " ", "\n", " a", "a ", "a\n", "\n\n", "a\tb\tc\t\n", "  a  b\x1cc", "a\0b c", "Hello <|endoftext|>world's  ÉΣ ΑΣ 12 ﬁ İI 中文字 é ́x",
       "🎉🎉 aaaaaaaaaaaaaaaaaaaaaaaa \x85\xa0 <|startoftext|><|endoftext|> x", "don't we'll 'S x'VE 1234 &&&***!!! ___ � ​ zz​z"]


def texts(seed: int, n: int = 300) -> list[str]:
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice("aabcdeéßñ'! 1\nthing\t") for _ in range(rnd.randint(0, 120))) for _ in range(n)]


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 20, 31])
def test_pack_round_trip_and_random_access(bits):
    rnd = np.random.default_rng(bits)
    lengths = [0, 5, 0, 700, 64, 1]
    ids = rnd.integers(0, 1 << bits, sum(lengths)).astype(np.uint32)
    data = bitpack.pack_file(list(range(6)), lengths, ids, bits, block_ids=128)
    f = bitpack.PackedFile(data)
    assert (f.ids(0, len(ids)) == ids).all()
    at = 0
    for i, n in enumerate(lengths):
        assert (f.document(i) == ids[at: at + n]).all()
        at += n
    for a, b in ((0, 1), (127, 129), (300, 640), (769, 770)):
        assert (f.ids(a, b) == ids[a:b]).all()


def test_width():
    assert [bitpack.bits_for(v) for v in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        bitpack.pack_file([1], [1], np.array([4], np.uint32), 2)


def test_byte_level_encoder_equals_library():
    path = scratch.tokenizer_file("byte_bpe_50k.json")
    ours, lib = bitpack.ByteLevelEncoder(path, limit=200), Tokenizer.from_file(path)
    for t in texts(1):
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("limit,step", [(200, 1), (200, 7), (400_000, 10_000)])
def test_columns_are_encoded_as_row_by_row(limit, step):
    import pyarrow as pa
    path = scratch.tokenizer_file("byte_bpe_50k.json")
    ours, lib = bitpack.ByteLevelEncoder(path, limit=limit), Tokenizer.from_file(path)
    rows = texts(7) + ["x\u2003y", "“quoted” a\u3000b", "a\u1680b", "\u2009", "ends\n", "\nstarts", "", "é\u0301 ñ", "one\ntwo three's"]
    column = pa.array(["left out", *rows]).slice(1)
    for lo in range(0, len(rows), step):
        ids, counts = ours.encode_column(column.slice(lo, step))
        want = [lib.encode(t, add_special_tokens=False).ids for t in rows[lo: lo + step]]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_prefix_bpe_equals_library():
    path = scratch.tokenizer_file("word_bpe_49k.json")
    ours, lib = prefixbpe.PrefixBPE(path, limit=200), Tokenizer.from_file(path)
    rnd = random.Random(5)
    vocabulary = [t.replace("</w>", "") for t in ours.tokens.values()]
    more = [" ".join(rnd.sample(vocabulary, 300)) for _ in range(10)] + ["".join(rnd.sample(vocabulary, 8)) for _ in range(300)]
    for t in texts(2) + more:
        got, want = ours.encode(t), lib.encode(t, add_special_tokens=False).ids
        assert got.tolist() == want, t
        assert ours.decode(got) == lib.decode(want, skip_special_tokens=False)


def test_packed_table(spark):
    rows = [(7, "seven words of text here"), (3, None), (5, ""), (7, "seven words of text here"), (9, "the end\n" * 3000), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted(bitpack.read_packed(bitpack.write_packed(df)).collect(), key=lambda r: r.start)
    lib = Tokenizer.from_file(scratch.tokenizer_file("byte_bpe_50k.json"))
    at = 0
    for r, (k, t) in zip(got, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")), strict=True):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        assert (r.key, r.start, r.n_tokens, r.ids_crc32) == (k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert bitpack.read_packed(bitpack.write_packed(df.limit(0))).count() == 0


def test_encode_decode_table(spark):
    lib = Tokenizer.from_file(scratch.tokenizer_file("word_bpe_49k.json"))
    rows = [(i, t) for i, t in enumerate([*texts(3, 60), None, "word " * 50_000])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("decoded", F.lit(1))
    got = {r.doc_id: r for r in prefixbpe.encode_decode(df).collect()}
    for i, t in rows:
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == want
        assert got[i].decoded == lib.decode(want, skip_special_tokens=False)
    assert prefixbpe.encode_decode(df.limit(0)).count() == 0


def test_prefix_bpe_memos_keep_what_is_used_and_stay_bounded():
    path = scratch.tokenizer_file("word_bpe_49k.json")
    ours, lib = prefixbpe.PrefixBPE(path, limit=50), Tokenizer.from_file(path)
    encoded, plain = [], ours.word
    ours.word = lambda chars: encoded.append(chars) or plain(chars)
    rnd = random.Random(9)
    for k in range(400):
        text = f"often Often, x{k}y don't {rnd.choice('ABé')}{k} \x7f\x01z{k}"
        assert ours.encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids, text
        assert max(map(len, (ours, ours.words, ours.old_pieces, ours.old_words))) <= 50
    assert encoded.count("often") == 1      # a full memo does not forget it


def test_workers_keep_their_encoder():
    assert prefixbpe.worker_encoder("word_bpe_49k.json") is prefixbpe.worker_encoder("word_bpe_49k.json")


def test_workers_forget_texts_when_a_task_ends(spark):
    rows = [(i, f"worker{i} keeps nothing, x{i}y") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)

    def held(batches):
        for _ in batches:
            pass
        e = prefixbpe.worker_encoder("word_bpe_49k.json")
        yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, (e, e.words, e.old_pieces, e.old_words, e.pairs)))])], names=["n"])

    fresh = prefixbpe.PrefixBPE(scratch.tokenizer_file("word_bpe_49k.json"))
    assert prefixbpe.encode_decode(df).agg(F.sum(F.size("ids"))).first()[0] == sum(len(fresh.encode(t)) for _, t in rows)
    assert [r.n for r in df.mapInArrow(held, "n long").collect()] == [0] * 8


def test_prefix_bpe_remembers_no_long_pieces():
    path = scratch.tokenizer_file("word_bpe_49k.json")
    ours, lib = prefixbpe.PrefixBPE(path), Tokenizer.from_file(path)
    for text in ("ab" * 5000, "語文" * 3000, "x1" * 3000 + " ab", "\x1c" + "é" * 4000):
        for _ in range(2):
            assert ours.encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids
    assert max(map(len, [*ours, *ours.words])) <= prefixbpe.LONGEST
    ours.forget()
    assert not any((ours, ours.words, ours.old_pieces, ours.old_words, ours.pairs, ours.edges))
    assert ours.encode("ab again").tolist() == lib.encode("ab again", add_special_tokens=False).ids
