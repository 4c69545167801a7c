"""Order-dependent building blocks against brute force, with blocks small enough to cross."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from sparkcdc.operators import ordered
from sparkcdc.operators.ordered import asof_lookup, dense_positions, nearest_ranks, running
from sparkcdc.operators.segments import Measure, greedy_cuts


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("backward", [True, False])
def test_asof_lookup(spark, seed, strict, backward):
    rng = random.Random(seed)
    left = [(rng.choice("ab"), rng.randrange(-50, 400), i) for i in range(300)]
    right = [(rng.choice("ab"), rng.choice([rng.randrange(0, 40), rng.randrange(150, 330)]), i) for i in range(60)]
    got = asof_lookup(
        spark.createDataFrame(left, "k string, x bigint, i bigint"),
        spark.createDataFrame(right, "k string, y bigint, p bigint"),
        ["k"], "x", "y", ["p"], 16, strict, backward,
    )
    have = {r["i"]: r["p"] for r in got.collect()}
    for k, x, i in left:
        if backward:
            fits = [(y, p) for kk, y, p in right if kk == k and (y < x if strict else y <= x)]
            want = max(fits)[1] if fits else None
        else:
            fits = [(y, p) for kk, y, p in right if kk == k and (y > x if strict else y >= x)]
            want = min(fits)[1] if fits else None
        assert have[i] == want, (k, x)


def test_asof_lookup_without_keys_or_partners(spark):
    left = spark.createDataFrame([(5,)], "x bigint")
    right = spark.createDataFrame([], "y bigint, p bigint")
    assert asof_lookup(left, right, [], "x", "y", ["p"], 8).collect() == [(5, None)]


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("reverse", [True, False])
def test_running(spark, inclusive, reverse):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), i * 3, rng.choice([None, rng.randrange(100)])) for i in range(200)]
    specs = {"s": ("sum", F.col("v")), "c": ("count", F.col("v")), "m": ("max", F.col("v")), "l": ("last", F.col("v"))}
    got = running(spark.createDataFrame(rows, "k string, o bigint, v bigint"), ["k"], "o", specs, 17, inclusive=inclusive, reverse=reverse)
    for r in got.collect():
        def inside(o):
            return (o == r["o"] and inclusive) or (o > r["o"] if reverse else o < r["o"])

        seen = [(o, v) for k, o, v in rows if k == r["k"] and inside(o) and v is not None]
        seen.sort(reverse=reverse)
        assert r["s"] == sum(v for _, v in seen) and r["c"] == len(seen)
        assert r["m"] == max((v for _, v in seen), default=None)
        assert r["l"] == (seen[-1][1] if seen else None)


def test_dense_positions_ignore_partitioning(spark):
    rows = [(i * 7 % 101, i) for i in range(101)]
    df = spark.createDataFrame(rows, "o bigint, t bigint")
    answers = [
        {(r["o"], r["n"]) for r in dense_positions(df.repartition(n), [], "o", "n", 10).collect()} for n in (1, 5)
    ]
    assert answers[0] == answers[1] == {(o, o + 1) for o, _ in rows}


def test_nearest_ranks(spark):
    rows = [("a", v) for v in [5, 1, 1, 9, 7, 3]] + [("b", 4)]
    ranks = {"p50": (50, 100), "upper": (1, 2, "ceil"), "max": (1, 1)}
    got = {r["g"]: r for r in nearest_ranks(spark.createDataFrame(rows, "g string, v bigint"), ["g"], "v", ranks, 2).collect()}
    assert (got["a"]["p50"], got["a"]["upper"], got["a"]["max"], got["a"]["n"]) == (3, 5, 9, 6)
    assert (got["b"]["p50"], got["b"]["max"]) == (4, 4)


def greedy(rows, batch, limit):
    number, count, size, out = 0, 0, 0, {}
    for o, s in sorted(rows):
        if number == 0 or count == batch or size + s > limit:
            number, count, size = number + 1, 0, 0
        count, size = count + 1, size + s
        out[o] = number
    return out


@pytest.mark.parametrize("seed,batch,limit,width,fan", [(1, 5, 60, 8, 2), (2, 50, 1000, 4, 3), (3, 3, 10, 64, 64), (4, 40, 90, 2, 2)])
def test_greedy_cuts_by_count_and_bytes(spark, seed, batch, limit, width, fan):
    rng = random.Random(seed)
    rows = [(k, o, rng.randrange(0, 30)) for k in ("a", "b") for o in sorted(rng.sample(range(600), 250))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "k string, o bigint, s bigint, one bigint")
    cut = greedy_cuts(df, ["k"], "o", [Measure("one", batch, True), Measure("s", limit, True)], "seg", width, fan)
    have = {(r["k"], r["o"]): r["seg"] for r in cut.collect()}
    for k in ("a", "b"):
        want = greedy([(o, s) for kk, o, s in rows if kk == k], batch, limit)
        assert {o: have[(k, o)] for o in want} == want


@pytest.mark.parametrize("seed,every,width,fan", [(1, 40, 8, 2), (2, 400, 4, 2), (3, 1, 16, 4)])
def test_greedy_cuts_by_time(spark, seed, every, width, fan):
    rng = random.Random(seed)
    at, rows = 0, []
    for o in range(300):
        at += rng.choice([0, 0, 1, 5, 60])
        rows.append((o, at))
    cut = greedy_cuts(spark.createDataFrame(rows, "o bigint, t bigint"), [], "o", [Measure("t", every - 1, False)], "seg", width, fan)
    have = {r["o"] for r in cut.collect() if r["seg_start"]}
    want, last = set(), None
    for o, t in rows:
        if last is None or t - last >= every:
            want.add(o)
            last = t
    assert have == want


@pytest.mark.parametrize("backward", [False, True])
def test_asof_over_empty_key_space(spark, backward):
    """Right rows that are far apart cost a row each, not a row per bucket between them."""
    keys = [k * 10**12 + k % 7 for k in range(10_000)]
    right = spark.createDataFrame([(k, k // 10**12) for k in keys], "at long, p long")
    left = spark.createDataFrame([(k + d, k + d) for k in keys[::50] for d in (-1, 0, 1, 5 * 10**11)] + [(None, -5)], "v long, id long")
    got = {r["id"]: r["p"] for r in asof_lookup(left, right, [], "v", "at", ["p"], 64, strict=False, backward=backward).collect()}
    import bisect

    for k in keys[::50]:
        for d in (-1, 0, 1, 5 * 10**11):
            at = bisect.bisect_right(keys, k + d) - 1 if backward else bisect.bisect_left(keys, k + d)
            assert got[k + d] == (keys[at] // 10**12 if 0 <= at < len(keys) else None)
    assert got[-5] is None


def test_asof_rows_follow_the_input(spark):
    two = spark.createDataFrame([(1, "a"), (2 * 10**11, "b")], "at long, p string")
    left = spark.createDataFrame([(0,), (5,), (10**11,), (2 * 10**11,)], "v long")
    got = asof_lookup(left, two, [], "v", "at", ["p"], 64)
    assert sorted((r["v"], r["p"]) for r in got.collect()) == [(0, "a"), (5, "b"), (10**11, "b"), (2 * 10**11, None)]


def test_range_running_and_median_on_any_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0.5, -1.0, 3.25, 3.25, rng.random()]), i) for i in range(2000)]
    rows += [("c", None, 1), ("d", 7.0, 1), ("e", 1.0, 1), ("e", 2.0, 2)]
    df = spark.createDataFrame(rows, "k string, v double, i int").repartition(5)
    got = ordered.range_running(df, ["k"], ["v", "i"], F.lit(1).cast("bigint"), "at").collect()
    assert len(got) == len(rows)
    for k in {r[0] for r in rows}:
        want = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0.0, r[2]))
        assert [(r.v, r.i) for r in sorted((r for r in got if r.k == k), key=lambda r: r.at)] == [r[1:] for r in want]
        assert sorted(r.at for r in got if r.k == k) == list(range(1, len(want) + 1))
    medians = {r.k: r.v for r in ordered.exact_median(df, ["k"], "v").collect()}
    for k in {r[0] for r in rows} - {"c"}:
        assert medians[k] == statistics.median(r[1] for r in rows if r[0] == k)
    assert "c" not in medians
    whole = [r[1] for r in rows if r[1] is not None]
    assert ordered.exact_median(df, [], "v").first().v == statistics.median(whole)
    assert ordered.range_running(df.where("false"), [], ["v"], F.lit(1), "at").count() == 0
