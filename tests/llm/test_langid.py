import zlib

import numpy as np
import pytest

from sparkcdc.llm import langid

FOLDER = "/root/testdata/sf0.01"


def slow_forward_backward(scores, moves, start):
    """All paths of one chain."""
    import itertools

    n, k = scores.shape
    gamma, total = np.zeros((n, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        weight = np.exp(start[path[0]] + sum(scores[i, p] for i, p in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += weight
        for i, p in enumerate(path):
            gamma[i, p] += weight
    return gamma / total


def test_marginals_against_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 5, 3, 5, 2])
    scores, moves, start = rng.normal(size=(16, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    gamma, pairs, starts = langid.forward_backward(scores, lengths, moves, start)
    at = 0
    for n in lengths:
        assert np.allclose(gamma[at : at + n], slow_forward_backward(scores[at : at + n], moves, start))
        at += n
    assert np.isclose(pairs.sum(), (lengths - 1).sum()) and np.isclose(starts.sum(), len(lengths))


def test_long_sentence_and_strange_words():
    model = langid.fit(["the cat and the dog"] * 5 + ["der hund und die katze"] * 5, ["en"] * 5 + ["de"] * 5)
    labeller = langid.Labeller(model)
    names, scores = labeller.label(["the dog " * 9000, None, "", "12 ² ٣ !!", "der 7 hund", "\x00é𝔘"])
    assert names[:5] == ["en", "und", "und", "und", "de"] and scores[1:4] == [0.0] * 3 and names[5] in ("en", "de")
    runs = labeller.runs("the cat and the dog der hund und die katze")
    assert runs[0][2] == "en" and runs[-1][2] == "de"
    assert labeller.label(["the"])[0] == langid.Labeller(langid.Model.load(model.dump()), limit=0).label(["the"])[0]


def test_rows_of_every_sort(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", "s") for i in range(40)]
    rows += [(None, "the dog", "en", "s"), (50, None, "en", None), (51, "the the", None, None), (0, rows[0][1], "de", "s"), (52, "3 4", "de", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    model = langid.train(docs)
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "lang", "lang_pred", "score"}
    assert {r.lang_pred for r in got if r.doc_id in (50, 52)} == {"und"}
    assert all(r.lang_pred == ("en" if r.text.startswith("the") else "de") for r in got if r.text and r.text != "3 4")
    empty = docs.where("false")
    assert langid.identify(empty, langid.train(empty)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, langid.train(empty)).collect()} == {"und"}


def test_held_out_accuracy(spark):
    from sparkcdc.llm.queries import QUERIES

    told = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect())
    rows = QUERIES["op10_language_id"](spark, FOLDER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(told) and sum(r.lang_pred == told[r.doc_id] for r in held) >= 0.97 * len(held)


@pytest.mark.parametrize("bits", [8, 17])
def test_features_do_not_depend_on_neighbours(bits):
    words = ["a", "été", "hund", "𝔘x"]
    feature, owner = langid.features(words, bits)
    for i, w in enumerate(words):
        alone, _ = langid.features([w], bits)
        assert sorted(feature[owner == i]) == sorted(alone)


def test_sample_does_not_depend_on_the_order_of_rows_that_share_an_id(spark):
    words = {"en": ["the", "cat", "and", "house"], "de": ["der", "hund", "und", "haus"]}
    rows = [(i, " ".join(f"{w}{'abcdefghij'[(i + k) % 10]}" for w in words[lang]), lang) for i in range(12) for lang in words for k in range(6)]
    rows += rows[:30]
    models = []
    for given in (rows, rows[::-1]):
        docs = spark.createDataFrame(given, "doc_id bigint, text string, lang string").coalesce(1)
        models.append(langid.train(docs, per_language=4).dump())
    assert models[0] == models[1]


@pytest.mark.parametrize("ids", [(11, 14), (5, 8), (100, 101)])
def test_many_rows_on_few_ids_keep_their_language(spark, ids):
    """How often rows repeat an id, or repeat altogether, decides nothing about which languages are learned."""
    english = [(k, f"the cat number {k} sat on the mat and looked at the house", "en") for k in range(1000, 4000)]
    german = [(ids[k % 2], f"die katze nummer {k % 900} sass auf der matte und sah das haus", "de") for k in range(6000)]
    same = [(ids[0], "el gato se sienta en la casa y mira la puerta", "es")] * 6000 + [(ids[1], "el gato se sienta en la casa y mira la puerta", "es")] * 6000
    docs = spark.createDataFrame(english + german + same, "doc_id long, text string, lang string").repartition(8)
    usable = {r["l"] for r in docs.where((langid.remainder(docs["doc_id"]) != 1)).selectExpr("lang AS l").distinct().collect()}
    assert set(langid.train(docs).languages) == usable
