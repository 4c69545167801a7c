"""External spill counting against counting everything in one dictionary."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from sparkcdc.llm import bpe, crosstok

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Plain alignment of a list of texts by the two libraries."""
    lib_a = tokenizers.Tokenizer.from_file(A)
    lib_a.encode_special_tokens = True
    lib_b = sentencepiece.SentencePieceProcessor(model_file=B)
    bytes_of = {c: b for b, c in bpe.byte_characters().items()}

    def piece_bytes(i):
        return bytes([int(lib_b.id_to_piece(i)[3:5], 16)]) if lib_b.is_byte(i) else lib_b.id_to_piece(i).replace("▁", " ").encode()

    def align(texts):
        rows, counts = [], Counter()
        for text in texts:
            groups, links = [], []
            if text:
                ids_a, ids_b = lib_a.encode(" " + text, add_special_tokens=False).ids, lib_b.encode(text)
                raw_a = [bytes(bytes_of[c] for c in lib_a.id_to_token(i)) for i in ids_a]
                raw_b = [piece_bytes(i) for i in ids_b]
                if b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                    ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
                    low_a = low_b = 0
                    for end in sorted(set(ends_a) & set(ends_b)):
                        i, j = ends_a.index(end, low_a), ends_b.index(end, low_b)
                        groups.append((ids_a[low_a : i + 1], ids_b[low_b : j + 1]))
                        links.append((ids_a[i], ids_b[j]))
                        low_a, low_b = i + 1, j + 1
            rows.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), groups, links))
            counts.update(links)
        top = defaultdict(int)
        for (_, b), n in counts.items():
            top[b] = max(top[b], n)
        return [
            (n_a, n_b, len(groups), len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
             ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups))
            for n_a, n_b, groups, links in rows
        ]

    return align


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def rows_of(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def test_odd_rows(spark, plain):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "a", "é", "中", "🙂", "the", " cat", "<|endoftext|>", "<s>", "▁", "\x00", "ing", "1", " "]
    texts = [None, "", " ", "▁", "a", "a", "the cat sat\n", "x" * 3000, "word " * 9000]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(300)]
    docs = spark.createDataFrame([(None if k % 7 == 0 else k % 50, t, k, "x") for k, t in enumerate(texts)], "doc_id long, text string, place long, groups string")
    got = crosstok.cross_align(docs.repartition(5), A, B)
    assert got.columns == ["doc_id", "place", *crosstok.RESULTS]
    want = plain(texts)
    assert {r["place"]: tuple(r[n] for n in NAMES) for r in got.collect()} == dict(enumerate(want))


def test_small_blocks_and_shares(spark, plain, monkeypatch):
    """Many batches, many blocks a run, several merges and several tasks a radix give the same answer."""
    for name, value in {"BATCH_BYTES": 300, "BLOCK": 3, "FAN": 2, "ROW": 5, "SHARE_BYTES": 200, "LEAST_RADICES": 2}.items():
        monkeypatch.setattr(crosstok, name, value)
    rng = random.Random(8)
    words = ["the", "cat", "sat", "unbelievable", "tokenisation", "naïve", "über", "x1"]
    texts = [" ".join(rng.choices(words, weights=[30, 9, 5, 1, 1, 1, 1, 1], k=rng.randint(1, 20))) for _ in range(200)] + ["the"] * 100
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    assert rows_of(crosstok.cross_align(docs, A, B)) == sorted(plain(texts))


def test_empty_table_and_digest(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([], "doc_id long, text string")
    assert crosstok.cross_align(docs, A, B).count() == 0
    one = crosstok.cross_align(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), A, B, shown=lambda g: F.sha2(g, 256)).collect()
    assert {r["doc_id"]: len(r["groups"]) for r in one} == {1: 64, 2: 0}


def test_merge_of_runs():
    rng = np.random.default_rng(4)
    runs, want = [], Counter()
    for _ in range(150):
        keys = np.unique(rng.integers(0, 30_000, rng.integers(1, 9000)))
        counts = rng.integers(1, 5, len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append(crosstok.pack_run(keys, counts))
    keys, counts = (np.concatenate(x) for x in zip(*crosstok.merge_runs(runs)))
    assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), counts.tolist())) == want
    assert list(crosstok.merge_runs([])) == []


def test_spread_can_be_undone():
    ids = np.arange(1 << crosstok.B_BITS)
    assert len(np.unique(crosstok.spread(ids))) == len(ids)


def test_query_against_the_libraries(spark, plain):
    from sparkcdc.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = {}
    for (doc, _), row in zip(given, plain([t for _, t in given])):
        want[doc] = (*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "")
    got = QUERIES["op12_cross_align"](spark, folder)
    assert {r.doc_id: tuple(r[n] for n in (*NAMES[:-1], "groups_sha256")) for r in got.collect()} == want
