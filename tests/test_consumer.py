"""The guarded consumer, idempotent apply, and reports."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkcdc.operators import inbox, monitor, progress, reconcile

S = 1_000_000
T = 1_000 * S
LOG = (
    "consumer string, seq bigint, topic string, partition int, offset bigint, key string, value_bytes int, kind string, version int,"
    " boundary_us bigint, now_us bigint, schema_name string, table_name string, reason string"
)


def record(seq, kind, now, boundary=None, boundary_us=None, **changes):
    row = dict(
        consumer="c", seq=seq, topic="t", partition=0, offset=seq, key="e", value_bytes=10, kind=kind,
        version=1 if kind == "boundary" else None, boundary_us=boundary_us if boundary is None else boundary, now_us=now,
        schema_name=None if kind == "boundary" else "s", table_name=None if kind == "boundary" else "items", reason=None,
    )
    row.update(changes)
    return tuple(row.values())


def check(spark, rows, skew=S // 10):
    scope = spark.createDataFrame([("s", "items")], "schema_name string, table_name string")
    accepted, failures = progress.check_log(spark.createDataFrame(rows, LOG), scope, F.lit("e"), "t", skew)
    return accepted, failures


def test_cold_start_and_a_lease_that_repeats_do_not_renew(spark):
    rows = [
        record(1, "boundary", T, T - S),
        record(2, "data", T + S),
        record(3, "boundary", T + 2 * S, T + 2 * S),
        record(4, "boundary", T + 4 * S, T + 2 * S),
    ]
    accepted, failures = check(spark, rows)
    assert accepted.count() == 4 and failures.count() == 0
    spans = progress.leases(accepted, F.lit(T), 5 * S, S // 10)
    probes = spark.createDataFrame([("c", t) for t in (T + S, T + 2 * S, T + 3 * S, int(T + 6.8 * S), int(T + 6.9 * S))], "consumer string, at_us bigint")
    none = spark.createDataFrame([], "consumer string, failed_us bigint")
    ready = [r["ready"] for r in progress.ready_at(probes, spans, none, S).orderBy("at_us").collect()]
    assert ready == [False, True, True, True, False]


@pytest.mark.parametrize(
    "bad,problem",
    [
        (dict(topic="x"), "other topic"),
        (dict(partition=1), "other partition"),
        (dict(offset=2), "offset does not rise"),
        (dict(key="other"), "other epoch"),
        (dict(value_bytes=(1 << 20) + 1), "record too large"),
        (dict(table_name="unknown"), "unknown table"),
        (dict(reason="malformed"), "invalid change"),
        (dict(kind="boundary", version=2, boundary_us=T), "unknown version"),
        (dict(kind="boundary", version=1, boundary_us=None), "missing boundary"),
        (dict(kind="boundary", version=1, boundary_us=T - 1), "boundary falls"),
        (dict(kind="boundary", version=1, boundary_us=T + 60 * S), "boundary in the future"),
    ],
)
def test_the_first_failure_is_final(spark, bad, problem):
    rows = [record(1, "boundary", T, T), record(2, "data", T + 1), record(3, now=T + 2, **{"kind": "data", **bad}), record(5, "boundary", T + 9, T + 5)]
    accepted, failures = check(spark, rows)
    assert [r["seq"] for r in accepted.orderBy("seq").collect()] == [1, 2]
    row = failures.first()
    assert (row["failed_seq"], row["problem"]) == (3, problem)


def test_offsets_may_have_holes(spark):
    accepted, failures = check(spark, [record(1, "data", T), record(90, "data", T)])
    assert accepted.count() == 2 and failures.count() == 0


def test_fill_fence(spark):
    accepted, _ = check(spark, [record(1, "boundary", T, T), record(2, "data", T + 2 * S)])
    spans = progress.leases(accepted, F.lit(T - 10 * S), 50 * S, 0)
    none = spark.createDataFrame([], "consumer string, failed_us bigint")
    reads = spark.createDataFrame(
        [("c", 1, T + S, 1, T + S + 10), ("c", 1, T + S, 1, T + 3 * S), ("c", 1, T + 3 * S, 2, T + 4 * S), ("c", 1, T + 3 * S, 1, T + 90 * S)],
        "consumer string, generation int, begin_us bigint, store_generation int, store_us bigint",
    )
    got = progress.cache_fill_valid(reads, accepted, spans, none, S).orderBy("begin_us", "store_us").collect()
    assert [r["valid"] for r in got] == [True, False, False, False]


def test_boundaries_follow_the_interval_and_reach_idle_routes(spark):
    ends = spark.createDataFrame([("s", i, i * 10) for i in range(1, 10)], "stream string, tick_id bigint, end_us bigint")
    routes = spark.createDataFrame([("s", "a"), ("s", "idle")], "stream string, topic string")
    got = progress.boundaries(ends, routes, 25)
    assert {(r["topic"], r["tick_id"]) for r in got.collect()} == {(t, i) for t in ("a", "idle") for i in (1, 4, 7)}
    assert progress.boundaries(ends, routes, 0).count() == 0


LOGGED = [("x", 1, b"k", b"first"), ("y", 2, b"k", b"second"), ("x", 3, b"k", b"first")]


def inbox_log(spark, rows):
    df = spark.createDataFrame([(i, o, bytearray(k), bytearray(v)) for i, o, k, v in rows], "id string, offset bigint, key binary, value binary")
    return inbox.with_digest(df)


def test_inbox_applies_once_and_fails_closed(spark):
    empty = spark.createDataFrame([], "id string, digest string")
    log = inbox_log(spark, LOGGED)
    effects = inbox.apply_inbox(log, empty)
    assert [bytes(r["value"]) for r in effects.orderBy("offset").collect()] == [b"first", b"second"]
    assert inbox.apply_inbox(log, effects.select("id", "digest")).count() == 0
    assert inbox.inbox_conflicts(log, effects.select("id", "digest")).count() == 0
    changed = inbox_log(spark, LOGGED + [("y", 4, b"k", b"other")])
    conflicts = inbox.inbox_conflicts(changed, empty)
    assert [r["id"] for r in conflicts.collect()] == ["y"]
    with pytest.raises(PySparkException):
        inbox.require_no_conflicts(inbox.apply_inbox(changed, empty), conflicts).collect()
    assert inbox.require_no_conflicts(inbox.apply_inbox(log, empty), inbox.inbox_conflicts(log, empty)).count() == 2


def test_inbox_stream_over_several_batches(spark, tmp_path):
    from sparkcdc.streaming.apply import inbox_stream

    ddl = "id string, offset bigint, key binary, value binary"

    def feed(rows):
        spark.createDataFrame([(i, o, bytearray(k), bytearray(v)) for i, o, k, v in rows], ddl).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        inbox_stream(source, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()

    feed(LOGGED)
    feed([("x", 9, b"k", b"first"), ("z", 10, b"k", b"third")])
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("offset").collect()
    assert [(r["id"], r["offset"]) for r in got] == [("x", 1), ("y", 2), ("z", 10)]
    with pytest.raises(PySparkException):
        feed([("z", 11, b"k", b"changed")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_inbox_stream_keeps_receipts_of_rows_an_effect_drops(spark, tmp_path):
    from sparkcdc.streaming.apply import inbox_stream

    ddl = "id string, offset bigint, key binary, value binary"

    def feed(rows, effect):
        spark.createDataFrame([(i, o, bytearray(k), bytearray(v)) for i, o, k, v in rows], ddl).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        inbox_stream(source, str(tmp_path / "out"), str(tmp_path / "cp"), effect).awaitTermination()

    def dropping(df):
        return df.where("id <> 'a'")

    feed([("a", 1, b"k", b"1"), ("b", 2, b"k", b"2")], dropping)
    feed([("a", 3, b"k", b"1"), ("c", 4, b"k", b"3")], lambda df: df.select("id", "value"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["b", "c"]
    with pytest.raises(PySparkException):
        feed([("c", 5, b"k", b"other")], dropping)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_receipts_by_bucket_over_many_batches_and_repeats(spark, tmp_path):
    """Against a dictionary; a batch in three is repeated, one is empty, and a batch opens one run per set bit."""
    import random

    from sparkcdc.streaming.apply import Receipts

    rng = random.Random(4)
    schema = "id string, digest string"
    store = Receipts(spark, str(tmp_path / "receipts"), schema, buckets=4)
    known = {}
    for batch in range(9):
        ids = [] if batch == 3 else rng.sample(range(40), 8)
        asked = spark.createDataFrame([(str(i),) for i in ids] * 2 + [(None,)], "id string")
        for _ in range(2 if batch % 3 == 1 else 1):
            store.begin(batch)
            got = {r["id"]: r["digest"] for r in store.of(asked, batch).collect()}
            assert got == {str(i): known[i] for i in ids if i in known}
            fresh = [(str(i), f"d{batch}") for i in ids if i not in known]
            store.add(spark.createDataFrame(fresh, schema), batch)
        known |= {i: f"d{batch}" for i in ids if i not in known}
        assert len(store.runs(batch)) == bin(batch).count("1")
    one = store.of(spark.createDataFrame([("1",)], "id string"), 9)
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()
    held = [p.parent.parent.name for p in (tmp_path / "receipts").rglob("*.parquet")]
    assert len(set(held)) <= 6 and "run=0-8" in held and "run=0-4" in held and "run=0-2" not in held


def test_materialize_moves_and_deletes(spark):
    ddl = "ev_id bigint, op string, old struct<id:bigint,v:string>, new struct<id:bigint,v:string>"
    rows = [
        (1, "INSERT", None, (1, "a")), (2, "UPDATE", (1, "a"), (3, "a")), (3, "INSERT", None, (1, "b")), (4, "DELETE", (3, "a"), None),
        (5, "INSERT", None, (7, "c")), (6, "UPDATE", (7, "c"), (7, "d")),
    ]
    got = inbox.materialize(spark.createDataFrame(rows, ddl), ["id"])
    assert {tuple(r) for r in got.collect()} == {(1, "b"), (7, "d")}


def test_reconcile_counts(spark):
    expected = spark.createDataFrame([(i, i * 10, f"s{i}") for i in range(1, 6)], "id bigint, sent_ns bigint, checksum string")
    received = spark.createDataFrame(
        [(1, 10, "s1", 15), (1, 10, "s1", 16), (2, 20, "bad", 25), (3, 31, "s3", 40), (4, 40, "s4", 44), (4, 40, "zz", 45), (9, 1, "s9", 2)],
        "id bigint, sent_ns bigint, checksum string, recv_ns bigint",
    )
    row = reconcile.reconcile(reconcile.reconcile_rows(expected, received)).first()
    assert row.asDict() == {"expected": 5, "missing": 1, "corrupt": 2, "phantoms": 1, "duplicates": 2, "changed_duplicates": 1}


def test_workers(spark):
    ddl = "worker string, seq bigint, at_us bigint, beat string"
    rows = [("a", 1, 0, "active"), ("a", 2, 50 * S, "activity"), ("b", 3, 0, "standby"), ("c", 4, 0, "failed"), ("c", 5, 50 * S, "activity"), ("d", 6, 50 * S, "starting")]
    status = monitor.worker_status(spark.createDataFrame(rows, ddl), "1970-01-01 00:01:00", 30, 1 << 20)
    assert {r["worker"]: r["phase"] for r in status.collect()} == {"a": "active", "b": "stalled", "c": "failed", "d": "starting"}
    assert monitor.readiness(status).first()["ready"] is False
    assert monitor.readiness(status.where(F.col("worker") == "a")).first()["ready"] is True
    assert monitor.readiness(status.limit(0)).first()["ready"] is False


def test_transitions_and_repeated_failures(spark):
    ddl = "stream string, seq bigint, at_us bigint, phase string"
    phases = [(0, "active"), (10, "failed"), (20, "failed"), (70, "failed"), (129, "failed"), (131, "failed"), (140, "conflict"), (150, "active"), (160, "active")]
    log = spark.createDataFrame([("s", i, t * S, p) for i, (t, p) in enumerate(phases)], ddl)
    got = [(r["phase"], r["outage_us"], r["failures"]) for r in monitor.transitions(log, 2).orderBy("seq").collect()]
    assert got == [("active", None, None), ("failed", None, None), ("conflict", None, None), ("active", 10 * S, 1)]
    repeats = [(r["at_us"] // S, r["failures"]) for r in monitor.repeat_summary(log, 60, 2).orderBy("seq").collect()]
    assert repeats == [(70, 3), (131, 5)]
