"""Capture, rendering, retries, and the guards that stop a job."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkcdc.functions import text
from sparkcdc.operators import capture, render, retry
from sparkcdc.sources import eventlog

ROW = "id:bigint,name:string,ok:boolean,amount:double,at:timestamp,raw:binary,`weird Col`:string"
FEED = f"op string, old struct<{ROW}>, new struct<{ROW}>"


def row(i, name="a", weird=None):
    import datetime

    return (i, name, True, 12.5, datetime.datetime(2024, 1, 2, 3, 4, 5, 60000), bytearray(b"\x00\xff"), weird)


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED)


OPTIONS = render.Options(pkey=["id"], table="items")


def test_json_event(spark):
    e = render.render_json(feed(spark, [("INSERT", None, row(1, 'q"é'))]), OPTIONS).first()
    assert e["ev_type"] == '{"op":"INSERT","table":["public","items"],"pkey":["id"]}'
    assert e["ev_data"] == '{"id":1,"name":"q\\"é","ok":true,"amount":"12.5","at":"2024-01-02T03:04:05.06","raw":"\\\\x00ff","weird Col":null}'
    assert e["ev_extra1"] == "public.items"


def test_urlencoded_event(spark):
    e = render.render_urlencoded(feed(spark, [("DELETE", row(1, "a b*é"), None)]), OPTIONS).first()
    assert e["ev_type"] == "D:id"
    assert e["ev_data"] == "id=1&name=a+b%2a%c3%a9&ok=t&amount=12.5&at=2024-01-02+03%3a04%3a05.06&raw=%5cx00ff&weird+Col"


def test_sql_events(spark):
    changes = [
        ("INSERT", None, row(1, "o'x")),
        ("UPDATE", row(1, "a"), row(1, None, "w\\")),
        ("UPDATE", row(1), row(1)),
        ("DELETE", row(1), None),
        ("TRUNCATE", None, None),
    ]
    got = [(r["ev_type"], r["ev_data"]) for r in render.render_sql(feed(spark, changes), OPTIONS).collect()]
    assert got[0] == (
        "I", "(id,name,ok,amount,at,raw,\"weird Col\") values ('1','o''x','t','12.5','2024-01-02 03:04:05.06',E'\\\\x00ff',null)"
    )
    assert got[1] == ("U", "name=NULL,\"weird Col\"=E'w\\\\' where id='1'")
    assert got[2] == ("U", "id='1' where id='1'")
    assert got[3:] == [("D", "id='1'"), ("R", "")]


def test_ignored_only_updates_make_no_event(spark):
    changes = feed(spark, [("UPDATE", row(1), row(1, "b")), ("UPDATE", row(1), row(1, "b", "w")), ("UPDATE", row(1), row(1))])
    for fn in (render.render_json, render.render_urlencoded, render.render_sql):
        assert fn(changes, render.Options(pkey=["id"], ignore=["name"])).count() == 2


def test_when_fields_and_magic_columns(spark):
    options = render.Options(pkey=["id"], when="name <> 'skip'", fields={"ev_extra3": "id + 1"}, magic="weird ")
    changes = spark.createDataFrame(
        [("INSERT", None, (1, "a", "typed")), ("INSERT", None, (2, "skip", "t")), ("DELETE", (3, None, "t"), None)],
        "op string, old struct<id:bigint,name:string,`weird type`:string>, new struct<id:bigint,name:string,`weird type`:string>",
    )
    got = render.render_json(changes, options).collect()
    assert [(r["ev_type"], r["ev_data"], r["ev_extra3"]) for r in got] == [("typed", '{"id":1,"name":"a"}', "2")]


def test_guards_stop_the_job(spark):
    moved = feed(spark, [("UPDATE", row(1), row(2))])
    for fn in (render.render_json, render.render_urlencoded, render.render_sql):
        with pytest.raises(PySparkException):
            fn(moved, OPTIONS).collect()
    with pytest.raises(PySparkException):
        render.render_json(feed(spark, [("DELETE", row(1), None)]), render.Options(pkey=[])).collect()
    with pytest.raises(PySparkException):
        render.render_json(feed(spark, [("INSERT", None, row(1))]), render.Options(pkey=["id"], deny=True)).collect()
    with pytest.raises(PySparkException):
        capture.reject_truncate(feed(spark, [("TRUNCATE", None, None)])).collect()
    with pytest.raises(PySparkException):
        capture.enforce_size(spark.createDataFrame([("x" * 524_289,)], "body string"), "body").collect()
    assert capture.enforce_size(spark.createDataFrame([("x" * 524_288,)], "body string"), "body").count() == 1


def test_key_move_is_kept_by_full_capture(spark):
    moved = feed(spark, [("UPDATE", row(1), row(3)), ("DELETE", row(3), None)])
    bodies = [r["body"] for r in capture.capture_feed(moved, "public", "items").collect()]
    assert '"before":{"id":1,' in bodies[0] and '"after":{"id":3,' in bodies[0]
    assert bodies[1].endswith('"after":null}')
    assert capture.key_moves(moved, ["id"]).select("old_id", "new_id").collect() == [(1, 3)]


def test_capture_target(spark):
    good = spark.createDataFrame([(1,), (2,)], "id bigint")
    bad = spark.createDataFrame([(1,), (1,), (None,)], "id bigint")
    got = {r["table"]: (r["null_keys"], r["duplicate_keys"], r["capturable"]) for r in capture.check_target({"g": (good, ["id"]), "b": (bad, ["id"])}).collect()}
    assert got == {"g": (0, 0, True), "b": (1, 1, False)}
    for tables in ({}, {"": (good, ["id"])}, {"g": (good, [])}):
        with pytest.raises(ValueError):
            capture.check_target(tables)


@pytest.mark.parametrize(
    "value,want",
    [(0.0, "0"), (-0.5, "-0.5"), (100.0, "100"), (1e7, "10000000"), (123456789012345.6, "123456789012345.6"), (1e15, "1e+15"), (1.5e300, "1.5e+300"),
     (0.0001, "0.0001"), (0.00001, "1e-05"), (float("inf"), "Infinity"), (float("nan"), "NaN")],
)
def test_double_text(spark, value, want):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(text.double_text(F.col("x")).alias("t")).first()["t"] == want


def test_quoting(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), (None,)], "x string")
    got = [tuple(r) for r in df.select(text.quote_literal(F.col("x")), text.quote_nullable(F.col("x"))).collect()]
    assert got == [("'it''s'",) * 2, ("E'a\\\\b'",) * 2, (None, "NULL")]
    names = spark.createDataFrame([("a.b.c",), ("Tab",), ("order",), ("x.y\"z",)], "x string")
    assert [r[0] for r in names.select(text.quote_fqname(F.col("x"))).collect()] == ['a."b.c"', 'public."Tab"', 'public."order"', 'x."y""z"']


EVENT = "queue string, ev_id bigint, ev_time timestamp, ev_retry int, ev_type string, ev_data string"


def test_sixth_failure_is_dead(spark):
    batch = spark.createDataFrame([("q", 1, None, None, "t", "stored"), ("q", 2, None, 4, "t", "d"), ("q", 3, None, 5, "t", "d")], EVENT)
    failures = spark.createDataFrame([(1, None), (2, None), (3, None), (9, None)], "ev_id bigint, reason string")
    queues = spark.createDataFrame([("q", None)], "queue string, max_retries int")
    routed = retry.nack_route(batch, failures, queues)
    assert {r["ev_id"]: (r["route"], r["dl_reason"]) for r in routed.collect()} == {
        1: ("retry", None), 2: ("retry", None), 3: ("dead", "max retries exceeded"), 9: ("unknown", None)
    }
    with pytest.raises(PySparkException):
        retry.require_known(routed).collect()


def test_append_rules(spark):
    rows = spark.createDataFrame([(30, None, "a"), (10, 5, None), (20, None, None)], "at bigint, ev_id bigint, ev_type string")
    got = eventlog.append_events(rows, "at", [], F.lit(100).cast("bigint"))
    assert {r["at"]: (r["ev_id"], r["ev_type"]) for r in got.collect()} == {10: (5, "default"), 20: (101, "default"), 30: (102, "a")}
    with pytest.raises(PySparkException):
        eventlog.append_events(rows, "at", [], F.lit(0).cast("bigint"), disabled=F.col("at") == 20).collect()


def test_bulk_append_order_and_errors(spark):
    rows = spark.createDataFrame([(2, ["c"]), (1, ["a", "b"]), (3, [])], "o bigint, p array<string>")
    got = eventlog.append_batch(rows, "o", "p", F.lit(10).cast("bigint"), 2)
    assert {r["o"]: r["ids"] for r in got.collect()} == {1: [11, 12], 2: [13], 3: []}
    assert {(r["ev_id"], r["ev_data"]) for r in eventlog.batch_rows(got, "p").collect()} == {(11, "a"), (12, "b"), (13, "c")}
    with pytest.raises(PySparkException):
        eventlog.append_batch(spark.createDataFrame([(1, None)], "o bigint, p array<string>"), "o", "p", F.lit(0), 2).collect()


def test_segments_on_disk_prune(spark, tmp_path):
    rows = spark.createDataFrame([("q", i % 3, i) for i in range(30)], "queue string, segment int, ev_txid bigint")
    eventlog.write_segments(rows, str(tmp_path / "log"))
    back = eventlog.read_events(spark, str(tmp_path / "log")).where("segment = 1 and queue = 'q'")
    assert back.count() == 10
    assert "PartitionFilters: [isnotnull" in back._jdf.queryExecution().toString()


def test_facts_must_be_there(spark):
    jobs = spark.createDataFrame([(1, "a"), (2, "b")], "job_id bigint, delivery_id string")
    facts = spark.createDataFrame([(1, "a")], "job_id bigint, delivery_id string")
    with pytest.raises(PySparkException):
        eventlog.require_facts(eventlog.facts_for_jobs(jobs, facts)).collect()
