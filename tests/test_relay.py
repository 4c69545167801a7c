"""Streaming delivery under failure."""

import time

import pytest
from pyspark.errors import PySparkException

from sparkcdc.streaming import relay

DDL = "ev_id bigint, ev_data string"


def change(n, schema="s"):
    return f'{{"schema":"{schema}","table":"t","op":"INSERT","before":null,"after":{{"id":{n}}}}}'


def put(spark, path, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(str(path))


def start(spark, tmp_path, publish, encode=None, name="cp"):
    source = spark.readStream.schema(DDL).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    encode = encode or relay.cdc_encoder("ep", None, "topic")
    return relay.relay_stream(source, encode, publish, str(tmp_path / name))


def test_lost_acknowledgement_replays_the_same_bytes(spark, tmp_path):
    put(spark, tmp_path / "in", [(1, change(1)), (2, change(2))])
    publish = relay.fenced_sink(str(tmp_path / "log"))
    seen = []

    def crash_after_write(records, batch_id):
        seen.append(sorted((r["ev_id"], bytes(r["value"])) for r in records.collect()))
        publish(records, batch_id)
        if len(seen) == 1:
            raise RuntimeError("acknowledgement lost")

    with pytest.raises(PySparkException):
        start(spark, tmp_path, crash_after_write).awaitTermination()
    start(spark, tmp_path, crash_after_write).awaitTermination()
    assert seen[0] == seen[1]
    assert relay.read_fenced(spark, str(tmp_path / "log")).count() == 2


def test_managed_replay_duplicates_until_applied(spark, tmp_path):
    put(spark, tmp_path / "in", [(1, change(1)), (2, change(2))])
    publish, calls = relay.managed_sink(str(tmp_path / "log")), []

    def crash_after_write(records, batch_id):
        publish(records, batch_id)
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("acknowledgement lost")

    with pytest.raises(PySparkException):
        start(spark, tmp_path, crash_after_write).awaitTermination()
    start(spark, tmp_path, crash_after_write).awaitTermination()
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 4 and relay.applied(log).count() == 2
    from pyspark.sql import functions as F

    replays = relay.replay_check(log.withColumn("id", F.col("ev_id").cast("string")))
    assert {(r["copies"], r["contents"]) for r in replays.collect()} == {(2, 1)}


def test_poison_blocks_its_batch_and_hides_the_payload(spark, tmp_path):
    put(spark, tmp_path / "in", [(1, change(1)), (2, "{secret"), (3, change(3))])
    query = start(spark, tmp_path, relay.fenced_sink(str(tmp_path / "log")))
    with pytest.raises(PySparkException) as caught:
        query.awaitTermination()
    assert "not a JSON object" in str(caught.value) and "secret" not in str(caught.value)
    assert not (tmp_path / "log" / "markers").exists()


def test_unrouted_schema_fails_the_batch(spark, tmp_path):
    put(spark, tmp_path / "in", [(1, change(1)), (2, change(2, "nowhere"))])
    routes = spark.createDataFrame([("s", "topic-s")], "schema string, topic string")
    with pytest.raises(PySparkException):
        start(spark, tmp_path, relay.fenced_sink(str(tmp_path / "log")), relay.cdc_encoder("ep", routes)).awaitTermination()


def test_a_failing_stream_does_not_stop_the_others(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    put(spark, good / "in", [(1, change(1))])
    put(spark, bad / "in", [(1, "{")])
    starts, now = [], [0.0]

    def failing():
        starts.append(now[0])
        return start(spark, bad, relay.fenced_sink(str(bad / "log")))

    def pause(seconds):
        time.sleep(seconds)
        if not any(q.isActive for q in spark.streams.active):
            now[0] += 1.0

    state = relay.run_streams(
        {"good": lambda: start(spark, good, relay.fenced_sink(str(good / "log"))), "bad": failing},
        pause=pause, clock=lambda: now[0], stop=lambda: len(starts) == 5,
    )
    assert state["good"] == "done" and state["bad"] != "done"
    # 1, 2, 4, 5 s: each start is later than the one before by its own pause at least.
    assert all(b - a >= w for a, b, w in zip(starts, starts[1:], (1, 2, 4, 5)))
    assert relay.read_fenced(spark, str(good / "log")).count() == 1


def test_a_stream_that_cannot_start_is_tried_again(spark, tmp_path):
    good, late = tmp_path / "good", tmp_path / "late"
    for place in (good, late):
        put(spark, place / "in", [(1, change(1))])
    tries = []

    def starter():
        tries.append(1)
        if len(tries) < 4:
            raise ConnectionError("source not there")
        return start(spark, late, relay.fenced_sink(str(late / "log")))

    now = [0.0]

    def pause(seconds):
        time.sleep(seconds)
        now[0] += 1.0

    state = relay.run_streams({"late": starter, "good": lambda: start(spark, good, relay.fenced_sink(str(good / "log")))}, pause=pause, clock=lambda: now[0])
    assert state == {"good": "done", "late": "done"} and len(tries) == 4
    assert relay.read_fenced(spark, str(late / "log")).count() == relay.read_fenced(spark, str(good / "log")).count() == 1


def test_a_stream_that_never_starts_is_reported(spark):
    def starter():
        raise ConnectionError("source not there")

    tries = []
    assert relay.run_streams({"s": starter}, pause=lambda s: tries.append(s), stop=lambda: len(tries) > 3) == {"s": "ConnectionError"}


def test_a_long_run_starts_the_pauses_anew():
    class Query:
        def __init__(self, clock, lasts):
            self.clock, self.end = clock, clock() + lasts

        @property
        def isActive(self):
            return self.clock() < self.end

        def exception(self):
            return RuntimeError("lost")

        def stop(self):
            pass

    now, began = [0.0], []

    def pause(seconds):
        now[0] += 0.5

    def starter():
        began.append(now[0])
        return Query(lambda: now[0], 9 if len(began) < 4 else 11)

    relay.run_streams({"s": starter}, pause=pause, clock=lambda: now[0], stop=lambda: len(began) > 4)
    pauses = [b - a for a, b in zip(began, began[1:])]
    # Nine seconds are no healthy run: 1, 2, 4 s; eleven are: 1 s again.
    assert [round(p - lasts) for p, lasts in zip(pauses, (9, 9, 9, 11))] == [1, 2, 4, 1]


def test_the_first_arrival_counts_and_conflicts_show(spark):
    rows = [(1, 5, b"zz"), (1, 7, b"aa"), (2, 6, b"same"), (2, 9, b"same"), (3, 8, b"one")]
    log = spark.createDataFrame([("t", b"k", v, None, n, at) for n, at, v in rows], relay.RECORD_DDL + ", offset long")
    got = {r["ev_id"]: (bytes(r["value"]), r["copies"], r["conflict"]) for r in relay.applied(log, "offset").collect()}
    assert got == {1: (b"zz", 2, True), 2: (b"same", 2, False), 3: (b"one", 1, False)}


def test_stream_count_is_bounded():
    with pytest.raises(ValueError):
        relay.run_streams({})


def test_over_limit_record_stops(spark, tmp_path):
    from sparkcdc.operators import envelope

    big = '{"schema":"s","table":"t","op":"INSERT","before":null,"after":{"v":"' + "\\\\" * 262_000 + '"}}'
    put(spark, tmp_path / "in", [(1, big)])
    assert len(big) <= 524_288 and envelope.MAX_RECORD_BYTES < 1 << 20
    with pytest.raises(PySparkException):
        start(spark, tmp_path, relay.fenced_sink(str(tmp_path / "log"))).awaitTermination()
