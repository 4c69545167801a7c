import gc
import hashlib
import random
import sys
import weakref

import public_tokenizers
import pytest
import tokenizers

from sparkcdc.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "a", "B", "é", "ß", "中", "'s", "'ll", "1", "²", "\t", "\x1c", "\x85", "᠎", "​", " ", "　", "!",
         "<|endoftext|>", "<|endoftext", "🙂", "é", "aaaa", "\r", "\x00", "Ⅷ", "the", " tion", "﻿"]


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(PATH)


@pytest.mark.parametrize("limit", [1 << 19, 3])
def test_ids_of_the_library(library, tokenizer, limit):
    rng = random.Random(7)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(3000)]
    encoder = bpe.Encoder(tokenizer, limit)
    for at in range(0, len(texts), 500):
        got = encoder.encode(texts[at : at + 500])
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 500]]
        assert [bpe.decode_ids(tokenizer, x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in got]


@pytest.mark.parametrize("text", ["a" * 5001, "ab" * 4000, " " * 3000 + "x", "z", "é" * 2500, "<|endoftext|>" * 400, "th" * 999 + "e"])
def test_long_words(library, tokenizer, text):
    assert bpe.Encoder(tokenizer).encode([text])[0] == library.encode(text, add_special_tokens=False).ids


def test_many_words_share_one_index(library, tokenizer):
    rng = random.Random(3)
    words = ["".join(rng.choices("abeinorst", k=rng.randint(1, 12))) for _ in range(2000)]
    assert tokenizer.encode_words([w.encode() for w in words]) == [tuple(library.encode(w, add_special_tokens=False).ids) for w in words]
    assert tokenizer.encode_words([]) == [] and tokenizer.encode_words([b"", b"a"])[0] == ()


def test_broken_bytes_decode_as_in_the_library(library, tokenizer):
    rng = random.Random(5)
    for _ in range(300):
        ids = [rng.randrange(256) for _ in range(6)]
        assert bpe.decode_ids(tokenizer, ids) == library.decode(ids, skip_special_tokens=False)


def test_rows_of_every_sort(spark, library):
    long = "The cat sat. " * 30_000
    rows = [(1, None, "x"), (2, "", "x"), (3, "hello  world", None), (3, "hello  world", None), (None, "é", "x"), (5, long, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").withColumn("row", docs_lit())
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "row", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.decoded == (r.text or "") and r.ids == library.encode(r.text or "", add_special_tokens=False).ids
    both = bpe.encode(docs, PATH, decoded="back")
    assert sorted((r.ids, r.back) for r in both.collect()) == sorted((r.ids, r.decoded) for r in got)
    empty = bpe.decode(bpe.encode(docs.where("false"), PATH), PATH)
    assert empty.count() == 0


def docs_lit():
    from pyspark.sql import functions as F

    return F.lit(1)


def test_null_ids_decode_to_nothing(spark):
    assert bpe.decode(spark.createDataFrame([(1, None)], "k int, ids array<int>"), PATH).first()["decoded"] == ""


def test_query_against_the_library(spark, library):
    from sparkcdc.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op1_bpe_roundtrip"](spark, folder).collect()}
    assert got == want


def test_forgotten_memories_go_at_once(tokenizer):
    gc.collect()
    gc.disable()
    try:
        encoder = bpe.Encoder(tokenizer, 3)
        before = weakref.ref(encoder.piece_ids)
        held = sys.getrefcount(encoder.pieces), sys.getrefcount(encoder.words)
        assert held == (sys.getrefcount({}) + 1,) * 2
        encoder.encode(["one two three four five six"])
        encoder.encode(["seven"])
        assert before() is None and len(encoder.pieces) == 1
    finally:
        gc.enable()
