import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcdc.llm import hamming


def brute(codes, asked, k):
    out = set()
    held = {}
    for i, code in set(codes):
        held.setdefault(i, []).append(code)
    for q, own in held.items():
        if asked(q):
            near = sorted((min(((c ^ o) & (2**64 - 1)).bit_count() for c in cs for o in own), i) for i, cs in held.items() if i != q)[:k]
            out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(near)}
    return out


@pytest.mark.parametrize(("n", "spread"), [(1, 0), (5, 64), (300, 3), (3000, 6), (3000, 64)])
def test_against_all_rows(spark, n, spread, monkeypatch):
    rng = np.random.default_rng(n + spread)
    centres = rng.integers(-(2**63), 2**63 - 1, 20)
    codes = []
    for i in range(n):
        code = int(centres[rng.integers(20)])
        for b in rng.integers(0, 64, rng.integers(0, spread + 1)):
            code ^= 1 << int(b)
        code &= 2**64 - 1
        codes.append((i * 3, code - 2**64 if code >= 2**63 else code))
    codes += codes[:2]
    monkeypatch.setattr(hamming, "BLOCK_CODES", 1000)
    monkeypatch.setattr(hamming, "CHUNK_QUERIES", 40)
    df = spark.createDataFrame(codes, "id bigint, code bigint").distinct()
    got = {tuple(r) for r in hamming.top_k(df, F.col("id") % 20 == 0, 7).collect()}
    assert got == brute(codes, lambda q: q % 20 == 0, 7)


def test_one_code_for_many_rows(spark):
    codes = [(i, 5 if i % 3 else i) for i in range(600)]
    got = {tuple(r) for r in hamming.top_k(spark.createDataFrame(codes, "id bigint, code bigint"), F.col("id") < 9, 4).collect()}
    assert got == brute(codes, lambda q: q < 9, 4)


def test_rows_of_every_sort(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0, None]), (None, [1.0, 2.0]), (5, [-1.0, 2.0]), (1, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec bigint, e array<double>").withColumn("code", F.lit(1)).withColumn("id", F.lit(0))
    codes = hamming.sign_codes(df, "vec", "e")
    assert sorted(r.id for r in codes.collect()) == [1, 5]
    assert [(r.id, r.rank, r.neighbour) for r in hamming.top_k(codes, F.col("id") == 1).collect()] == [(1, 1, 5)]
    assert hamming.top_k(codes.where("false"), F.lit(True)).count() == 0


def test_query_against_all_rows(spark):
    from sparkcdc.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    codes = [tuple(r) for r in hamming.sign_codes(vectors, "vec_id", "embedding").collect()]
    got = {tuple(r) for r in QUERIES["op3_hamming_top_k"](spark, folder).select("vec_id", "rank", "neighbour", "distance").collect()}
    assert got == brute(codes, lambda q: q % 20 == 0, 10)


def test_ids_with_several_codes(spark, monkeypatch):
    rng = np.random.default_rng(11)
    # One id holds a third of all rows, near everything that is asked; some rows repeat.
    near = [1 << int(b) for b in rng.integers(0, 40, 700)]
    codes = [(7, c) for c in near[:300]] + [(int(rng.integers(0, 60)), c ^ int(rng.integers(0, 64))) for c in near]
    codes += [(20, 5), (20, -5), (1, 5), (1, 4), (1, -5), (2, 7), (3, -5)] + codes[:20]
    monkeypatch.setattr(hamming, "BLOCK_CODES", 100)
    df = spark.createDataFrame(codes, "id bigint, code bigint")
    got = [tuple(r) for r in hamming.top_k(df, F.col("id") % 20 == 0, 3).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(codes, lambda q: q % 20 == 0, 3)
