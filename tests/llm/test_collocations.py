"""Counting quotient filters and phrases against plain dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from sparkcdc.llm import collocations as c


@pytest.mark.parametrize("bits, words, shard_bits", [(16, 5, 4), (21, 5, 6), (25, 5, 3), (32, 5, 1), (3, 5, 2), (10, 2, 5), (40, 3, 2)])
def test_permutation_loses_nothing(bits, words, shard_bits):
    rng = np.random.default_rng(1)
    layout = c.Layout(bits, words, shard_bits)
    numbers = [rng.integers(0, 1 << bits, 5000) for _ in range(words)]
    lanes = layout.permute(layout.pack(numbers))
    assert all(int(lane.max()).bit_length() <= width for lane, width in zip(lanes, layout.widths))
    assert all((a == b).all() for a, b in zip(layout.unpack(layout.undo(lanes)), numbers))
    keys, counts = c.added_up(lanes, np.ones(5000, np.int64))
    want = Counter(zip(*[n.tolist() for n in numbers]))
    assert Counter(dict(zip(zip(*[n.tolist() for n in layout.unpack(layout.undo(keys))]), counts.tolist()))) == want


def test_filters_merge_without_loss(monkeypatch):
    monkeypatch.setattr(c, "RANGE", 50)
    rng = np.random.default_rng(2)
    layout, want, shards = c.Layout(9, 5, 3), Counter(), {}
    for _ in range(20):
        n = int(rng.integers(1, 400))
        numbers = [rng.integers(0, 4, n) for _ in range(5)]
        counts = rng.integers(1, 600, n)
        for row, k in zip(zip(*[x.tolist() for x in numbers]), counts.tolist()):
            want[row] += k
        lanes, counts = c.added_up(layout.permute(layout.pack(numbers)), counts)
        shard = layout.shard(lanes)
        for s in np.unique(shard).tolist():
            own = shard == s
            raw = c.to_filter(layout, [lane[own] for lane in lanes], counts[own])
            back, n_back = c.from_filter(layout, s, raw)
            assert all((a == b[own]).all() for a, b in zip(back, lanes)) and (n_back == counts[own]).all()
            shards.setdefault(s, []).append(raw)
    got = Counter()
    for s, filters in shards.items():
        before = None
        for lanes, counts in c.merge_filters(layout, s, filters):
            assert before is None or before < int(lanes[0][0])
            before = int(lanes[0][-1])
            got.update(dict(zip(zip(*[x.tolist() for x in layout.unpack(layout.undo(lanes))]), counts.tolist())))
    assert got == want


def plain(rows, min_count, share=100):
    """Candidates, scores and inclusion by the letter."""
    counts, sizes, out = {}, Counter(), set()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^ \t]+", piece)
            sizes[lang] += len(words)
            for s in range(1, 6):
                for i in range(len(words) - s + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + s])] += 1
    for lang, f in counts.items():
        often = {p for p, n in f.items() if len(p) > 1 and n >= min_count}
        for p in often:
            longer = [q for q in often if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * f[q] >= share * f[p] for q in longer):
                continue
            score, _, l, r = min((1000 * f[p] * sizes[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            out.add((lang, " ".join(p), f[p], l, r, sizes[lang], score))
    return out


COLUMNS = ("lang", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("min_count, share, block", [(2, 100, 8_000_000), (3, 80, 200), (1, 100, 8_000_000)])
def test_phrases_by_the_letter(spark, monkeypatch, min_count, share, block):
    monkeypatch.setattr(c, "BLOCK_BYTES", block)
    rng = random.Random(6)
    words = ["the", "The", "cat", "sat", "on", "É", "é", "new york", "a\x01b", "x\x1cy", "\xa0", "中文", "a,b", "end.\n", "\t"]
    rows = [(rng.choice(["en", "de", None, "und", ""]), " ".join(rng.choices(words, k=rng.randint(0, 25)))) for _ in range(150)]
    rows += [("en", None), ("en", ""), (None, "  "), ("fr", "once only"), ("en", "a b a b a b a b"), ("en", "a b a b a b a b")]
    docs = spark.createDataFrame([(k % 3, *r, 7) for k, r in enumerate(rows)], "doc_id long, lang string, text string, n long").repartition(4)
    got = c.collocations(docs, min_count=min_count, share=share).collect()
    assert len(got) == len({tuple(r[x] for x in COLUMNS) for r in got})
    assert {tuple(r[x] for x in COLUMNS) for r in got} == plain(rows, min_count, share)


def test_products_beyond_64_bits_are_exact(spark):
    from pyspark.sql import functions as F

    row = spark.sql("SELECT 9000000000 AS a, 9000000000000 AS n, 9000000001 AS l, 9000000007 AS r")
    score = row.select(F.expr("(cast(a AS decimal(38,0)) * n * 1000) div (cast(l AS decimal(38,0)) * r)").alias("s")).first()["s"]
    assert score == 1000 * 9000000000 * 9000000000000 // (9000000001 * 9000000007)


def test_nothing_to_count(spark):
    schema = "lang string, text string"
    assert c.collocations(spark.createDataFrame([], schema)).count() == 0
    assert c.collocations(spark.createDataFrame([("en", "a b"), ("en", None)], schema)).count() == 0


def test_ranks_are_per_language_with_ties(spark):
    rows = [("en", f"p{k:03}", 5 + k % 2, 9, 9, 99, 7) for k in range(300)] + [("de", "q", 1, 1, 1, 1, 1)]
    found = spark.createDataFrame(rows, "lang string, phrase string, a long, l long, r long, n long, score long")
    got = [(r.lang, r["rank"], r.phrase) for r in c.best(found, 10).collect()]
    want = sorted([r for r in rows if r[0] == "en"], key=lambda r: (-r[2], r[1]))[:10]
    assert sorted(got) == sorted([("en", k + 1, r[1]) for k, r in enumerate(want)] + [("de", 1, "q")])
