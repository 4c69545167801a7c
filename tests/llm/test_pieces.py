"""Merge rounds against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from sparkcdc.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "a", "B", "é", "中", "文", "'s", "1", "\t", "\x1c", " ", "!", "🙂", "the", " tion", "in", "er", "ing",
         "th", "he", "<s>", "</s>", "<0x41>", pieces.BLANK, pieces.BLANK * 2, "\x00", "xxx", "аб", "﻿"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.Model(PATH)


def check(library, model, texts, limit=pieces.KNOWN_CHARACTERS):
    flat, counts = pieces.Encoder(model, limit).encode(texts)
    at = 0
    for text, count in zip(texts, counts.tolist()):
        ids, at = flat[at : at + count].tolist(), at + count
        assert ids == library.encode(text), text[:80]
        assert pieces.decode_ids(model, ids) == library.decode(ids)
    assert at == len(flat)


@pytest.mark.parametrize("limit", [1 << 20, 10])
def test_odd_texts(library, model, limit):
    rng = random.Random(7)
    for _ in range(6):
        check(library, model, ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(500)], limit)


@pytest.mark.parametrize("letters", ["abcdefghijklmnoprstuvw", "etaoin", "ab", "a"])
def test_words_of_many_merges(library, model, letters):
    rng = random.Random(3)
    check(library, model, ["".join(rng.choices(letters, k=rng.randint(0, 400))) for _ in range(500)])


@pytest.mark.parametrize("text", ["a" * 5001, "ab" * 4000, " " * 3000 + "x", " " * 100_003, "z", "th" * 999 + "e", "中文" * 2000, "é" * 999])
def test_long_words(library, model, text):
    check(library, model, [text, "x" + text, text + " y"])


def test_runs_of_blanks(library, model):
    check(library, model, [" " * k + "x" + " " * (3 * k % 61) + "\n" for k in range(200)])


def test_long_texts_are_cut_at_word_starts(library, model, monkeypatch):
    monkeypatch.setattr(pieces, "STEP", 50)
    monkeypatch.setattr(pieces, "SLICE", 20)
    rng = random.Random(5)
    check(library, model, ["".join(rng.choices(PARTS + [" "] * 20, k=400)) for _ in range(100)] + [" " * 120, "x" * 300])


def test_rounds_equal_one_merge_at_a_time(library, model):
    rng = random.Random(11)
    for _ in range(200):
        word = "".join(rng.choices("abcdeinorst", k=rng.randint(1, 90)))
        assert pieces.merge_one(model, [model.plain[c] for c in pieces.BLANK + word]) == library.encode(word)


def test_any_ids_decode_as_in_the_library(library, model):
    rng = random.Random(5)
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.3 else rng.randrange(262) for _ in range(rng.randint(0, 12))]
        assert pieces.decode_ids(model, ids) == library.decode(ids)


def test_rows_of_every_sort(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "hello  world", None), (3, "hello  world", None), (None, "é", "x"), (5, "The cat sat. " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").selectExpr("*", "1 AS row", "2 AS `a.b`")
    both = pieces.encode(docs, PATH, decoded="back")
    assert both.columns == ["doc_id", "text", "row", "a.b", "ids", "back"]
    got = both.collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r.text or "")
        assert r.ids == want and r.back == library.decode(want)
    again = pieces.decode(both.drop("back"), PATH).collect()
    assert sorted((r.ids, r.decoded) for r in again) == sorted((r.ids, r.back) for r in got)
    assert pieces.encode(docs.where("false"), PATH, decoded="back").count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None)], "k int, ids array<int>"), PATH).first()["decoded"] == ""


def test_query_against_the_library(spark, library):
    from sparkcdc.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_sentencepiece"](spark, folder).collect()}
    assert got == want
