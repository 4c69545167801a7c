import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sparkcdc.llm import packing
from sparkcdc.llm.queries import RANKS


def plain(lengths, length):
    """Best fit decreasing by looking at every row."""
    room, rows, ages = [], [0] * len(lengths), []
    for step, i in enumerate(sorted(range(len(lengths)), key=lambda i: -lengths[i])):
        fits = [r for r in range(len(room)) if room[r] >= lengths[i]]
        if fits:
            # Of equal room, the row that came to have it first.
            row = min(fits, key=lambda r: (room[r], ages[r]))
        else:
            row = len(room)
            room.append(length)
            ages.append(step)
        room[row] -= lengths[i]
        ages[row] = step
        rows[i] = row
    return rows


@pytest.mark.parametrize("length", [1, 2, 7, 64, 100])
def test_against_looking_at_every_row(length):
    rng = random.Random(length)
    for n in (0, 1, 5, 300):
        lengths = [rng.randint(1, length) for _ in range(n)]
        assert packing.best_fit_decreasing(lengths, length) == plain(lengths, length)


def unpacked(rows, length, pad=0):
    back = {}
    for r in rows:
        ids, positions = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["position_ids"], "<u4")
        assert len(ids) == len(positions) == length and r["cu_seqlens"][0] == 0 and len(r["cu_seqlens"]) == len(r["segments"]) + 1
        for s, a, b in zip(r["segments"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert b - a == s["length"] > 0 and (positions[a:b] == np.arange(b - a)).all()
            back.setdefault(s["doc"], {})[s["at"]] = ids[a:b].tolist()
        assert (ids[r["cu_seqlens"][-1] :] == pad).all()
    return {d: [i for at in sorted(p) for i in p[at]] for d, p in back.items()}


def test_rows_of_every_sort(spark):
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "the " * 500), (None, "a")], "doc_id bigint, text string")
    packed = packing.pack_texts(texts, RANKS, public_tokenizers.PATTERN, length=64).collect()
    assert {d: len(x) for d, x in unpacked(packed, 64).items()} == {3: 501, None: 1}
    rows = [(1, None), (2, []), (3, [5]), (4, list(range(1000))), (5, [7] * 64), (None, [9, 9]), (6, [1, 2, 3])]
    df = spark.createDataFrame(rows, "doc_id bigint, ids array<int>").withColumn("segments", F.lit(1))
    for block in (1, 1 << 20):
        got = packing.pack(df.coalesce(1), length=64, block=block, pad=3).collect()
        assert unpacked(got, 64, 3) == {d: x for d, x in rows if x}
    assert packing.pack(df.where("false"), length=64).count() == 0


def test_query_loses_nothing_and_fills_rows(spark, tmp_path):
    from sparkcdc.llm import bpe
    from sparkcdc.llm.queries import QUERIES, TOKENIZER

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: r.ids for r in bpe.encode(docs, TOKENIZER).collect() if r.ids}
    got = QUERIES["op2_pack"](spark, folder)
    packing.write_packed(got, str(tmp_path / "packed"))
    rows = spark.read.parquet(str(tmp_path / "packed")).collect()
    assert unpacked(rows, packing.LENGTH) == want
    assert sum(map(len, want.values())) > 0.98 * packing.LENGTH * len(rows)
