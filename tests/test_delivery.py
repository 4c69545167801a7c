"""Ordered, chunked, fenced delivery of closed batches."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkcdc.functions import codecs
from sparkcdc.operators import outbox, progress
from sparkcdc.streaming import delivery, relay

EVENTS = "ev_id bigint, ev_txid bigint, ev_data string"
TICKS = "tick_id bigint, tick_time timestamp, xmin bigint, xmax bigint, xip array<bigint>, event_seq bigint"


def change(n, schema="s", pad=0):
    return f'{{"schema":"{schema}","table":"t","op":"INSERT","before":null,"after":{{"id":{n},"v":"{"x" * pad}"}}}}'


def tick(spark, n, xmax, xip=(), at=None):
    at = n if at is None else at
    return (n, f"2024-01-01 00:{at // 60:02}:{at % 60:02}", min([xmax, *xip]), xmax, list(xip), 0)


class Source:
    """A tick log, its arriving files and an event log in a folder."""

    def __init__(self, spark, path, events, ticks):
        self.spark, self.path = spark, path
        self.events = spark.createDataFrame(events, EVENTS).repartition(3)
        self.events.write.parquet(f"{path}/events")
        rows = [(n, at, lo, hi, xip, s) for n, at, lo, hi, xip, s in ticks]
        ddl = TICKS.replace("timestamp", "string")
        spark.createDataFrame(rows, ddl).withColumn("tick_time", F.to_timestamp("tick_time")).write.parquet(f"{path}/ticks")
        self.log = spark.read.schema(TICKS).parquet(f"{path}/ticks")

    def arrive(self, *numbers):
        self.log.where(F.col("tick_id").isin(*numbers)).coalesce(1).write.mode("append").parquet(f"{self.path}/new")

    def run(self, log, topics=("t",), encode=None, name="cp", **settings):
        fresh = self.spark.readStream.schema(TICKS).option("maxFilesPerTrigger", "1").parquet(f"{self.path}/new")
        events = self.spark.read.schema(EVENTS).parquet(f"{self.path}/events")
        encode = encode or relay.cdc_encoder("ep", None, topics[0])
        delivery.batch_stream(fresh, events, self.log, encode, log, list(topics), "ep", f"{self.path}/{name}", **settings).awaitTermination()


def shown(log):
    rows = log.read().orderBy("topic", "offset").collect()
    return [(r["topic"], r["offset"], r["batch_tick"], r["chunk"], r["kind"], r["ev_id"]) for r in rows]


def test_late_commit_lands_in_a_later_batch_and_empty_batches_close(spark, tmp_path):
    # Transaction 10 stays open over ticks 1 and 2; tick 3 holds nothing.
    source = Source(spark, tmp_path, [(1, 10, change(1)), (2, 11, change(2)), (3, 12, change(3))],
                    [tick(spark, 0, 10), tick(spark, 1, 12, [10]), tick(spark, 2, 13, [10]), tick(spark, 3, 13, [10]), tick(spark, 4, 13)])
    source.arrive(0, 1)
    source.arrive(2, 3)
    source.arrive(4)
    log = delivery.Log(spark, str(tmp_path / "log"))
    source.run(log, every_us=1)
    assert shown(log) == [
        ("t", 0, 1, 1, "data", 2), ("t", 1, 1, 2, "boundary", None),
        ("t", 2, 2, 1, "data", 3), ("t", 3, 2, 2, "boundary", None),
        ("t", 4, 3, 1, "boundary", None),
        ("t", 5, 4, 1, "data", 1), ("t", 6, 4, 2, "boundary", None),
    ]


def test_seventeen_rows_in_chunks_of_two(spark, tmp_path):
    events = [(n, 10 + n % 3, change(n)) for n in range(1, 18)]
    source = Source(spark, tmp_path, events, [tick(spark, 0, 10), tick(spark, 1, 13)])
    source.arrive(0, 1)
    log = delivery.Log(spark, str(tmp_path / "log"))
    source.run(log, batch=2)
    assert [(r[1], r[3], r[5]) for r in shown(log)] == [(n - 1, (n - 1) // 2 + 1, n) for n in range(1, 18)]


def test_bytes_cut_chunks_too(spark, tmp_path):
    sizes = [10, 500, 10, 10, 900, 10, 400, 300, 10]
    source = Source(spark, tmp_path, [(n + 1, 10, change(n, pad=p)) for n, p in enumerate(sizes)], [tick(spark, 0, 10), tick(spark, 1, 11)])
    source.arrive(0, 1)
    log = delivery.Log(spark, str(tmp_path / "log"))
    source.run(log, batch=3, batch_bytes=1000)
    rows = log.read().orderBy("offset").collect()
    want, chunk, count, held = [], 1, 0, 0
    for r in rows:
        size = len(r["key"]) + len(r["value"])
        if count == 3 or (count and held + size > 1000):
            chunk, count, held = chunk + 1, 0, 0
        count, held = count + 1, held + size
        want.append(chunk)
    assert [r["chunk"] for r in rows] == want and chunk > 4


class Stopped(Exception):
    pass


class Breaking(delivery.Log):
    """Fails after the rows of a wave, before its markers."""

    def __init__(self, spark, path, fail_at):
        super().__init__(spark, path)
        self.fail_at, self.calls = fail_at, 0

    def publish(self, rows, batch_id):
        self.calls += 1
        if self.calls == self.fail_at:
            rows.select("*", F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit("torn").alias("attempt")).write.mode("append").partitionBy("batch_id", "attempt").parquet(f"{self.path}/rows")
            raise Stopped("publisher lost")
        super().publish(rows, batch_id)


def test_a_torn_chunk_is_unseen_and_marked_chunks_are_left_alone(spark, tmp_path):
    source = Source(spark, tmp_path, [(n, 10 + n, change(n)) for n in range(1, 41)], [tick(spark, 0, 11), tick(spark, 1, 31), tick(spark, 2, 51)])
    source.arrive(0, 1)
    source.arrive(2)
    path = str(tmp_path / "log")
    torn = Breaking(spark, path, fail_at=3)
    with pytest.raises(PySparkException):
        source.run(torn, batch=5, wave=1, every_us=1)
    seen = delivery.Log(spark, path)
    # Two waves of one chunk each are out; the third is written but not marked.
    assert [r[5] for r in shown(seen)] == list(range(1, 11))
    first = seen.marks().select("batch_tick", "chunk", "attempt").collect()
    source.run(seen, batch=5, wave=1, every_us=1)
    rows = shown(seen)
    assert [r[1] for r in rows] == list(range(42)) and [r[5] for r in rows if r[4] == "data"] == list(range(1, 41))
    assert [r[1] for r in rows if r[4] == "boundary"] == [20, 41]
    assert set(first) <= set(seen.marks().select("batch_tick", "chunk", "attempt").collect())
    assert seen.marks().count() == 10


def test_routes_have_their_own_offsets_and_idle_ones_a_boundary(spark, tmp_path):
    events = [(n, 10, change(n, "a")) for n in range(1, 5)] + [(5, 10, change(5, "b")), (6, 11, change(6, "a"))]
    source = Source(spark, tmp_path, events, [tick(spark, 0, 10), tick(spark, 1, 11), tick(spark, 2, 12)])
    source.arrive(0, 1)
    source.arrive(2)
    routes = spark.createDataFrame([("a", "t-a"), ("b", "t-b"), ("c", "t-c")], "schema string, topic string")
    log = delivery.Log(spark, str(tmp_path / "log"))
    source.run(log, topics=("t-a", "t-b", "t-c"), encode=relay.cdc_encoder("ep", routes), every_us=1)
    assert [r[:3] + r[4:] for r in shown(log)] == [
        ("t-a", 0, 1, "data", 1), ("t-a", 1, 1, "data", 2), ("t-a", 2, 1, "data", 3), ("t-a", 3, 1, "data", 4), ("t-a", 4, 1, "boundary", None),
        ("t-a", 5, 2, "data", 6), ("t-a", 6, 2, "boundary", None),
        ("t-b", 0, 1, "data", 5), ("t-b", 1, 1, "boundary", None), ("t-b", 2, 2, "boundary", None),
        ("t-c", 0, 1, "boundary", None), ("t-c", 1, 2, "boundary", None),
    ]
    # Each boundary follows all rows of its batch on its route.
    data = log.read().where("kind = 'data'").groupBy("topic", "batch_tick").count()
    assert data.count() == 3
    value = log.read().where("kind = 'boundary' AND topic = 't-c' AND batch_tick = 2").first()["value"]
    assert json.loads(bytes(value)) == {"progress": {"version": 1, "source_epoch": "ep", "committed_before": "2024-01-01T00:00:02Z"}}


def test_boundaries_keep_their_distance_over_micro_batches(spark, tmp_path):
    ticks = [tick(spark, n, 10 + n, at=4 * n) for n in range(12)]
    source = Source(spark, tmp_path, [(n, 9 + n, change(n)) for n in range(1, 12)], ticks)
    for part in ((0, 1, 2), (3, 4), (5, 6, 7, 8), (9, 10, 11)):
        source.arrive(*part)
    log = delivery.Log(spark, str(tmp_path / "log"))
    source.run(log, every_us=10_000_000)
    at = [r[2] for r in shown(log) if r[4] == "boundary"]
    ends = spark.createDataFrame([(0, n, 4_000_000 * n) for n in range(1, 12)], "stream int, tick_id long, end_us long")
    assert at == sorted(r["tick_id"] for r in progress.due_batches(ends, 10_000_000).collect()) and len(at) > 2


def test_poison_stops_its_batch_before_anything_is_published(spark, tmp_path):
    source = Source(spark, tmp_path, [(1, 10, change(1)), (2, 11, "{secret"), (3, 11, change(3))], [tick(spark, 0, 10), tick(spark, 1, 11), tick(spark, 2, 12)])
    source.arrive(0, 1)
    source.arrive(2)
    log = delivery.Log(spark, str(tmp_path / "log"))
    with pytest.raises(PySparkException) as caught:
        source.run(log)
    assert "not a JSON object" in str(caught.value) and "secret" not in str(caught.value)
    assert [r[5] for r in shown(log)] == [1]


def test_managed_delivery_repeats_a_lost_acknowledgement(spark, tmp_path):
    source = Source(spark, tmp_path, [(n, 10, change(n)) for n in range(1, 6)], [tick(spark, 0, 10), tick(spark, 1, 11)])
    source.arrive(0, 1)
    log = delivery.Log(spark, str(tmp_path / "log"), fenced=False)

    class Lost(delivery.Log):
        def record_end(self, ends, batch_id):
            raise Stopped("acknowledgement lost")

    with pytest.raises(PySparkException):
        source.run(Lost(spark, log.path, fenced=False), every_us=1)
    source.run(log, every_us=1)
    rows = shown(log)
    assert len(rows) == 12 and len(set(rows)) == 6
    assert json.loads(bytes(log.read().where("kind = 'boundary'").first()["value"])).keys() == {"invalidation_progress"}


def test_outbox_keeps_order_past_a_held_key(spark, tmp_path):
    """Key 1 is held open while 17 others go out in order; it follows when it commits."""

    def body(n):
        ident = codecs.stable_uuid(F.lit(n))
        own = F.array(F.struct(F.lit("id").alias("key"), codecs.b64(codecs.utf8(ident)).alias("value")))
        return outbox.wrap(ident, codecs.utf8(F.lit(str(n))), codecs.utf8(F.lit(f"v{n}")), own)

    wrappers = spark.range(1).select(*[body(n).alias(f"b{n}") for n in (1, *range(3, 20))]).first()
    events = [(n, 10 + n, wrappers[f"b{n}"]) for n in (1, *range(3, 20))]
    source = Source(spark, tmp_path, events, [tick(spark, 0, 11), tick(spark, 1, 30, [11]), tick(spark, 2, 30)])
    source.arrive(0, 1)
    source.arrive(2)
    log = delivery.Log(spark, str(tmp_path / "log"))
    source.run(log, topics=("o",), encode=relay.outbox_encoder("o"), batch=4)
    rows = log.read().orderBy("offset").collect()
    assert [r["ev_id"] for r in rows] == [*range(3, 20), 1] and [bytes(r["value"]) for r in rows][:2] == [b"v3", b"v4"]
    assert [h["key"] for h in rows[0]["headers"]] == ["id"]


def test_topics_are_bounded(spark, tmp_path):
    log = delivery.Log(spark, str(tmp_path / "log"))
    with pytest.raises(ValueError):
        delivery.deliver(spark.createDataFrame([], EVENTS), spark.createDataFrame([], TICKS), spark.createDataFrame([], TICKS), 0, lambda b: b, log, [], "ep")


def test_nothing_to_close(spark, tmp_path):
    empty = spark.createDataFrame([], TICKS)
    assert delivery.closed_window(empty, empty) is None
    log = delivery.Log(spark, str(tmp_path / "log"))
    delivery.deliver(spark.createDataFrame([], EVENTS), empty, empty, 0, relay.cdc_encoder("ep", None, "t"), log, ["t"], "ep")
    assert log.read().count() == 0


def test_due_boundaries_are_worked_out_once_per_micro_batch(spark, tmp_path, monkeypatch):
    read = spark.sparkContext.accumulator(0)
    plain = delivery.due_batches

    @F.udf("bigint")
    def seen(n):
        read.add(1)
        return n

    monkeypatch.setattr(delivery, "due_batches", lambda *args: plain(*args).withColumn("tick_id", seen("tick_id")))
    source = Source(spark, tmp_path, [(n, 10 + n, change(n)) for n in range(1, 7)], [tick(spark, n, 11 + n) for n in range(7)])
    source.arrive(*range(7))
    log = delivery.Log(spark, str(tmp_path / "log"))
    source.run(log, every_us=1)
    assert [r[4] for r in shown(log)].count("boundary") == 6
    assert read.value == 6
