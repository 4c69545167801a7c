"""Visibility batching: late commits, rollback, windows, cursors."""

import random

from pyspark.sql import functions as F

from sparkcdc.functions.snapshot import parse_snapshot, snapshot_text
from sparkcdc.operators import batches, ticks

TICK = "tick_id bigint, tick_time timestamp, xmin bigint, xmax bigint, xip array<bigint>, event_seq bigint"


def tick_rows(spark, rows):
    return spark.createDataFrame(rows, "tick_id bigint, xmin bigint, xmax bigint, xip array<bigint>").selectExpr(
        "tick_id", "timestamp_micros(tick_id * 60000000) as tick_time", "xmin", "xmax", "xip", "tick_id * 10 as event_seq"
    )


def events(spark, rows):
    return spark.createDataFrame(rows, "ev_id bigint, ev_txid bigint")


def test_late_commit_lands_in_a_later_batch(spark):
    snaps = tick_rows(spark, [(1, 10, 12, [10]), (2, 13, 13, [])])
    got = batches.assign_batches(events(spark, [(1, 10), (2, 11)]), snaps)
    assert {r["ev_id"]: r["batch_tick"] for r in got.collect()} == {2: 1, 1: 2}


def test_unseen_work_stays_pending(spark):
    snaps = tick_rows(spark, [(1, 10, 12, [10])])
    got = batches.assign_batches(events(spark, [(1, 10), (2, 11), (3, 12)]), snaps)
    assert {r["ev_id"]: r["batch_tick"] for r in got.collect()} == {1: None, 2: 1, 3: None}


def test_assignment_equals_trying_every_tick(spark):
    rng = random.Random(5)
    ends = {t: t + 1 + rng.choice([0, 1, 3, 40, 90]) for t in range(100, 500)}
    snaps, pos, tick_id = [], 100, 0
    while pos < 620:
        pos += rng.choice([0, 1, 7, 25])
        tick_id += rng.choice([1, 1, 3])
        xip = sorted(t for t, e in ends.items() if t < pos < e)
        snaps.append((tick_id, xip[0] if xip else pos, pos, xip))
    rows = [(i, rng.randrange(100, 500)) for i in range(800)]
    got = batches.assign_batches(events(spark, rows), tick_rows(spark, snaps), width=32)
    for r in got.collect():
        seen = [t for t, lo, hi, xip in snaps if r["ev_txid"] < lo or (r["ev_txid"] < hi and r["ev_txid"] not in xip)]
        assert r["batch_tick"] == min(seen, default=None)


def test_one_batch_equals_window_and_owner(spark):
    last, cur = {"xmin": 10, "xmax": 14, "xip": [10, 12]}, {"xmin": 12, "xmax": 20, "xip": [12, 17]}
    rows = [(i, t, o) for i, (t, o) in enumerate([(9, None), (10, None), (12, None), (13, None), (15, 1), (15, 2), (17, None), (19, None), (20, None)])]
    df = spark.createDataFrame(rows, "ev_id bigint, ev_txid bigint, ev_owner int")
    assert [r["ev_id"] for r in batches.batch_events(df, last, cur, 1).collect()] == [1, 4, 7]


def test_range_narrowing_lists_far_transactions():
    last = {"xmin": 100, "xmax": 1000, "xip": [100, 300, 910, 950]}
    cur = {"xmin": 1001, "xmax": 1001, "xip": [300]}
    assert batches.cur_range(last, cur) == (910, [100])


def test_snapshot_text_round_trip(spark):
    row = spark.createDataFrame([("10:20:11,15",), ("7:7:",)], "t string").select(parse_snapshot(F.col("t")).alias("s"), "t")
    for r in row.select("s", "t", snapshot_text(F.col("s.xmin"), F.col("s.xmax"), F.col("s.xip")).alias("back")).collect():
        assert r["back"] == r["t"]


def test_find_tick_prefers_the_newest_unless_far_over(spark):
    snaps = tick_rows(spark, [(i, i, i, []) for i in range(1, 12)]).withColumn("queue", F.lit("q"))
    subs = spark.createDataFrame([("q", 1, 1), ("q", 2, 9), ("q", 3, 11)], "queue string, sub_id int, last_tick bigint")
    got = {r["sub_id"]: r["found_tick"] for r in batches.find_tick(subs, snaps, 20, None).collect()}
    # 100 new is more than twice 20: the first tick with 20; exactly 20 new: the newest; nothing new: none.
    assert got == {1: 3, 2: 11, 3: None}


def test_external_ticks(spark):
    queues = spark.createDataFrame([("x", True, False), ("p", True, True), ("i", False, False)], "queue string, external boolean, paused boolean")
    rows = [("x", 1, 5, 10), ("x", 2, 5, 10), ("x", 3, 6, 9), ("x", 4, 7, 10), ("p", 5, 1, 1), ("i", 6, 1, 1), ("z", 7, 1, 1)]
    got = ticks.external_tick_check(spark.createDataFrame(rows, "queue string, arrival bigint, tick_id bigint, event_seq bigint"), queues)
    assert {r["arrival"]: r["reason"] for r in got.collect()} == {
        1: None, 2: "tick id not rising", 3: "event seq falls", 4: None, 5: "paused", 6: "not external", 7: "queue not found"
    }


def test_idle_ticks_back_off(spark):
    minute = 60_000_000
    polls = spark.createDataFrame([("q", i * minute, 5, False) for i in range(0, 60)], "queue string, at_us bigint, event_seq bigint, forced boolean")
    queues = spark.createDataFrame([("q", 500, 3 * minute, 20 * minute, False, False)], "queue string, max_count bigint, max_lag_us bigint, idle_us bigint, paused boolean, external boolean")
    at = [r["at_us"] // minute for r in ticks.close_batches(polls, queues).orderBy("at_us").collect()]
    assert at[:2] == [0, 1]
    gaps = [b - a for a, b in zip(at, at[1:])]
    assert gaps == sorted(gaps) and max(gaps) == 20


def test_burst_and_force_close(spark):
    polls = spark.createDataFrame([("q", i, s) for i, s in [(1, 0), (2, 1), (3, 2), (4, 50), (5, 51)]], "queue string, at_us bigint, event_seq bigint")
    queues = spark.createDataFrame([("q", 40, 1000, 5000, False, False)], "queue string, max_count bigint, max_lag_us bigint, idle_us bigint, paused boolean, external boolean")
    assert [r["at_us"] for r in ticks.close_batches(polls, queues).collect()] == [1, 4]
    assert [r["at_us"] for r in ticks.close_batches(ticks.force_close(polls, "q", 2), queues).collect()] == [1, 2, 4]


def test_ticker_stream_equals_batch(spark, tmp_path):
    from sparkcdc.streaming.ticker import tick_stream

    rng = random.Random(3)
    rows, seq = [], 0
    for i in range(200):
        seq += rng.choice([0, 0, 0, 1, 30])
        rows.append(("q", i * 1000, seq, 40, 5000, 20000))
    ddl = "queue string, at_us bigint, event_seq bigint, max_count bigint, max_lag_us bigint, idle_us bigint"
    for n in range(4):
        spark.createDataFrame(rows[n * 50 : (n + 1) * 50], ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        out = tick_stream(source).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append")
        out.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    polls = spark.createDataFrame(rows, ddl).select("queue", "at_us", "event_seq")
    queues = spark.createDataFrame([("q", 40, 5000, 20000, False, False)], "queue string, max_count bigint, max_lag_us bigint, idle_us bigint, paused boolean, external boolean")
    want = {tuple(r) for r in ticks.close_batches(polls, queues).collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want


def test_ticker_stream_with_settings_force_and_external_ticks(spark, tmp_path):
    from sparkcdc.streaming.ticker import ANSWERS, CALLS, ticker_stream

    big = 1 << 60

    def call(queue, at, kind, seq=None, tick=None, limits=(None, None, None), paused=None, external=None):
        return (queue, at, kind, seq, tick, *limits, paused, external)

    batches_of_calls = [
        [
            call("q", 1, "poll", 5), call("q", 2, "queue", limits=(10, 1000, 5000)), call("q", 3, "poll", 7), call("q", 4, "poll", 8),
            call("q", 5, "force"), call("q", 6, "queue", paused=True), call("q", 7, "poll", 9), call("q", 8, "force"), call(None, 1, "poll", 1),
            call("x", 1, "queue", limits=(10, 1000, 5000), external=True), call("x", 2, "poll", 100), call("x", 3, "tick", big, big), call("x", 3, "tick", big, big),
            call("n", 1, "force"), call("n", 1, "poll", 3), call("n", 1, "shout", 3), call("n", None, "force"),
        ],
        [call("q", 9, "queue", paused=False), call("q", 10, "poll", 9), call("q", 11, "poll", 9), call("q", 11, "tick", 1, 9), call("q", 700, "poll")],
        [call("x", 4, "tick", big - 1, big + 1), call("x", 5, "tick", None, big + 2), call("x", 6, "queue", external=False), call("x", 7, "poll", big + 20), call("x", 8, "force")],
        [call("x", 9, "poll", big + 20)],
    ]
    for calls in batches_of_calls:
        spark.createDataFrame(calls, CALLS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(CALLS).parquet(str(tmp_path / "in"))
        out = ticker_stream(source).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append")
        out.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = sorted((tuple(r) for r in spark.read.schema(ANSWERS).parquet(str(tmp_path / "out")).collect()), key=lambda r: (r[0], r[2], r[1] or 0, r[5] or ""))
    assert got == [
        ("n", None, 1, None, "force", "queue not found"),
        ("q", 1, 3, 7, "poll", None),
        ("q", None, 8, None, "force", "paused"),
        ("q", 2, 10, 9, "poll", None),
        ("q", 9, 11, 1, "tick", "not external"),
        ("q", 3, 700, 9, "poll", None),
        ("x", big, 3, big, "tick", None),
        ("x", big, 3, big, "tick", "tick id not rising"),
        ("x", big + 1, 4, big - 1, "tick", "event seq falls"),
        ("x", big + 2, 5, big, "tick", None),
        ("x", big + 3, 7, big + 20, "poll", None),
        ("x", big + 4, 9, big + 20, "poll", None),
    ]


def test_receive_cuts_before_it_fans_out(spark):
    """The first rows of each window, by the letter, with retries for one owner; more subscriptions of a queue do not
    make more rows out of its events."""
    import random

    rng = random.Random(9)
    ticks = [("q", t, 10 * t, 10 * t, [], 5 * t) for t in range(1, 6)] + [("p", t, 10 * t, 10 * t, [], 5 * t) for t in range(1, 4)]
    tick_df = spark.createDataFrame(ticks, "queue string, tick_id long, xmin long, xmax long, xip array<long>, event_seq long").selectExpr("*", "timestamp_micros(tick_id * 60000000) AS tick_time")
    events = [(rng.choice("qp"), n, rng.choice([None, None, None, 1, 2, 3]), rng.randrange(1, 6)) for n in range(1, 200)] + [("q", 500, None, None)]
    assigned = spark.createDataFrame(events, "queue string, ev_id long, ev_owner int, batch_tick long")
    for copies in (1, 10):
        subs = [("q", s, s % 5 + 1 if s % 5 < 4 else 1) for s in range(1, 4 * copies)] + [("p", 1, 1), ("p", 2, 3)]
        sub_df = spark.createDataFrame(subs, "queue string, sub_id int, last_tick long").selectExpr("*", "cast(null AS long) AS next_tick", "cast(null AS long) AS batch_id")
        rows, cursors = batches.receive(sub_df, tick_df, assigned, 3)
        got = {}
        for r in rows.collect():
            got.setdefault((r["queue"], r["sub_id"]), []).append(r["ev_id"])
        for r in cursors.collect():
            start = next(t for q, s, t in subs if (q, s) == (r["queue"], r["sub_id"]))
            inside = sorted(n for q, n, owner, at in events if q == r["queue"] and at == start + 1 and owner in (None, r["sub_id"]))
            assert sorted(got.get((r["queue"], r["sub_id"]), [])) == inside[:3] and r["in_batch"] == len(inside)
