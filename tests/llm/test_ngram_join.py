import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcdc.llm import ngram_join


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(width, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, width=4, num=85, den=100):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if not a or not b or den * min(len(a), len(b)) < num * max(len(a), len(b)):
                continue
            both = len(a & b)
            if den * both >= num * (len(a) + len(b) - both):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min((x for x in (low.get(find(i)), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def got(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit("x")).withColumn("n", F.lit(1))
    return sorted(map(tuple, ngram_join.join_components(docs, **options).collect()), key=str)


def corpus(seed, bases, copies, edits):
    """Texts of all sizes and copies of them at every distance, chains included."""
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    texts = []
    for _ in range(bases):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 4, 5, 9, 20, 60, 150, 400]))
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, int(len(base) * edits)))):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.2:
                text += rng.choices(words, k=rng.randint(1, 1 + len(text) // 8))
            if rng.random() < 0.3:
                base = text
            texts.append(" ".join(text))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"width": 5, "num": 80}), (3, {"width": 2, "num": 90})])
def test_against_all_pairs(spark, seed, options):
    rows = corpus(seed, 60, 12, 0.06)
    assert got(spark, rows, **options) == brute(rows, **options)


@pytest.mark.parametrize("block", [1024, 16])
def test_one_large_group_at_the_border(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(4)
    base = ["b%d" % i for i in range(200)]
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(4 if i else 0):
            text[rng.randrange(200)] = "x%d" % rng.randrange(10**6)
        rows.append((i + 5, " ".join(text)))
    assert got(spark, rows) == brute(rows)


def test_rows_of_every_sort(spark):
    long = " ".join("k%d" % (i * i % 9973) for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, long), (8, long + " more"), (7, long),
            (None, "a b c d e"), (9, "A b c d e"), (None, None), (10, "é É"), (11, "é é"), (4, "other text of the same id here")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, [r for r in rows if r[0] == 1]) == [(1, 0, 1)]
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.join_components(docs).count() == 0


def least_of_each(rows, width=4, num=85, den=100):
    """One (id, text) of each component: the least id, none last, then the least digest."""
    rows = sorted(set(rows), key=str)
    label = {r: c for r, (_, _, c) in zip(rows, brute_in_order([(i, t) for i, (_, t) in enumerate(rows)], width, num, den))}
    best = {}
    for d, t in rows:
        rank = (d is None, d or 0, hashlib.sha256((t or "").encode()).digest())
        best[label[d, t]] = min(best.get(label[d, t], (rank, d, t)), (rank, d, t), key=lambda x: x[0])
    return sorted(((d, t) for _, d, t in best.values()), key=str)


def brute_in_order(rows, *options):
    return sorted(brute(rows, *options), key=lambda r: r[0])


def kept(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted(map(tuple, ngram_join.one_of_each(docs, **options).collect()), key=str)


def test_one_of_each_decides_by_row_where_ids_are_null(spark):
    rows = [(0, "one two three four five six"), (None, "one two three four five six"), (None, "clean and unique text of its own here"),
            (None, "a pair without any id at all"), (None, "A pair without any  id at all"), (None, "a pair without any id at all"), (None, None),
            (None, "")]
    want = least_of_each(rows)
    assert kept(spark, rows) == want and len(want) == 5
    assert [t for d, t in want if t and t.startswith("clean")] and sum(bool(t) and t.lower().startswith("a pair") for _, t in want) == 1


def test_one_of_each_decides_by_row_where_ids_repeat(spark):
    rows = [(0, "one two three four five six"), (1, "one two three four five six"), (1, "quite another text under this id"),
            (2, "quite another text under this id"), (2, "near  copies under one id only"), (2, "NEAR copies under one id only"), (3, "x"), (3, "x")]
    want = least_of_each(rows)
    assert kept(spark, rows) == want
    assert [d for d, _ in want] == [0, 1, 2, 3] and (1, "quite another text under this id") in want


def test_one_of_each_against_all_pairs_with_shared_ids(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, d % 20, d]), t) for d, t in corpus(6, 40, 8, 0.06)]
    assert kept(spark, rows, width=5, num=80) == least_of_each(rows, 5, 80)


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(5)
    bands = ngram_join.Bands(85, 100)
    for n in (1, 3, 8, 30, 200, 3000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for _ in range(20):
            b = a.copy()
            most = bands.difference(len(a), len(a))
            swap = rng.choice(len(b), most // 2, replace=False)
            b[swap] = rng.integers(0, 2**63, len(swap)).astype(np.uint64)
            b = np.unique(b)
            differ = len(np.setxor1d(a, b))
            assert ngram_join.sketch_distance(ngram_join.sketch(a), ngram_join.sketch(b)) <= differ
            assert set(bands.signatures(a)[0].tolist()) & set(bands.signatures(b)[0].tolist())


def test_query_against_all_pairs(spark):
    from sparkcdc.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op7_ngram_join"](spark, folder).collect()), key=str) == brute(rows)


def test_sieve_finds_every_chosen_row_and_few_others(spark):
    docs = spark.range(40_000).select(F.when(F.col("id") != 7, F.col("id")).alias("id"), F.unhex(F.md5(F.col("id").cast("string"))).alias("digest"), F.lit("t").alias("text"))
    chosen = docs.where("id IS NULL OR id % 8 = 0").select("id", "digest", F.lit(1).cast("bigint").alias("key"))
    found = ngram_join.sieved(docs, chosen, ["id", "digest"])
    assert found.columns == docs.columns
    assert chosen.join(found, chosen["id"].eqNullSafe(found["id"]) & (chosen["digest"] == found["digest"]), "left_anti").isEmpty()
    assert 5_001 <= found.count() < 5_001 + 35_000 // 6
    assert ngram_join.sieved(docs, chosen.limit(0), ["id", "digest"]).isEmpty()


def test_sieve_lets_few_others_through(spark):
    docs = spark.range(40_000).select("id", F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("digest"))
    chosen = docs.where("id % 10 = 0")
    found = ngram_join.sieved(docs, chosen, ["id", "digest"])
    assert found.join(chosen, ["id", "digest"], "left_semi").count() == 4_000
    assert found.count() - 4_000 < 36_000 / 16


@pytest.mark.parametrize("batch", [3, 10_000])
def test_one_segment_stands_for_all_of_the_same_classes(spark, batch):
    rng = random.Random(5)
    rows = [(sig, 2 * rng.randrange(-4, 5) + (sig % 5 > 0 and rng.random() < 0.5)) for sig in range(300) for _ in range(rng.choice([1, 1, 2, 3, 9]))]
    rows += [(sig, 2 * key) for sig in (400, 401, 402) for key in range(20)] + [(sig, 41) for sig in (400, 401, 402)]
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        found = ngram_join.shared_segments(spark.createDataFrame(rows, "sig bigint, mark bigint")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    expected = {}
    for sig in {s for s, _ in rows}:
        marks = {m for s, m in rows if s == sig}
        keys = frozenset(m & ~1 for m in marks)
        if len(keys) > 1 and any(m & 1 for m in marks):
            expected[keys] = expected.get(keys, 0) + 1
    members = {}
    for r in found:
        members.setdefault((r.sig, r.weight), set()).add(r.key)
    assert sorted((sorted(k), w) for (_, w), k in members.items()) == sorted((sorted(k), w) for k, w in expected.items())
    assert len(found) == sum(map(len, expected))
