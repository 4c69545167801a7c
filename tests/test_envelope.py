"""Wire forms: exact numbers, strict JSON, envelopes, outbox bytes."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkcdc.functions import jsonx
from sparkcdc.operators import envelope, outbox

WIDE = (
    '{"id":9223372036854775807,"decimal":12345678901234567890.00100,"exponent":1e-400,"null":null,"empty":"",'
    '"false":false,"bytes":"\\\\x00ff","array":[null,{},[],0]}'
)


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "ev_id bigint, ev_data string")


def reasons(spark, texts):
    return [r["reason"] for r in envelope.decode_change(frame(spark, texts)).orderBy("ev_id").collect()]


def test_typed_image_is_exact(spark):
    rows = envelope.typed_image(frame(spark, [WIDE]), "ev_data").collect()
    got = {r["field"]: r for r in rows}
    assert got["id"]["number_text"] == "9223372036854775807"
    assert got["decimal"]["number_text"] == "12345678901234567890.00100"
    assert got["exponent"]["number_text"] == "1e-400"
    assert got["null"]["kind"] == "null" and "missing" not in got
    assert got["empty"]["string"] == "" and got["false"]["bool"] is False
    assert got["bytes"]["string"] == "\\x00ff"
    assert got["array"]["json"] == "[null,{},[],0]" and len(json.loads(got["array"]["json"])) == 4


def test_typed_image_of_nothing(spark):
    assert envelope.typed_image(frame(spark, ["", "null", " null "]), "ev_data").count() == 0


@pytest.mark.parametrize("text", ["[]", '{"a":1', "{} {}", '{"a":1}]', '{"a":1}}', '{"a":01}', "{'a':1}", '{"a":NaN}', '{"a":' * 66 + "1" + "}" * 66])
def test_bad_images(spark, text):
    df = frame(spark, [text])
    assert df.select(envelope.image_reason(F.col("ev_data")).alias("r")).first()["r"] or text.count("{") == 1
    with pytest.raises(PySparkException):
        envelope.typed_image(df, "ev_data").collect()


def test_nesting_limit_is_thirty(spark):
    def nested(n):
        return '{"a":' * n + "1" + "}" * n

    df = frame(spark, [nested(30), nested(31), '{"a":' * 30 + "{}" + "}" * 30, '{"a":' + "[" * 30 + "]" * 30 + "}", '{"a":' + "[" * 31 + "]" * 31 + "}"])
    got = [r["d"] for r in df.select("ev_id", jsonx.too_deep(jsonx.tag(F.col("ev_data"))).alias("d")).orderBy("ev_id").collect()]
    assert got == [False, True, False, False, True]


def test_bad_changes(spark):
    image = '{"id":1}'
    texts = [
        "{",
        f'{{"schema":"s","table":"t","op":"DELETE","before":{image},"after":{image}}}',
        f'{{"schema":"s","table":"t","op":"UPDATE","before":null,"after":{image}}}',
        '{"schema":"s","table":"t","op":"TRUNCATE"}',
        f'{{"schema":"s","table":"t","op":"INSERT","after":{image}}}{{}}',
        f'{{"schema":"s","table":"t","op":"INSERT","after":{image}}},{{}}',
        f'{{"schema":true,"table":"t","op":"INSERT","after":{image}}}',
        f'{{"schema":"s","table":"t","op":1,"after":{image}}}',
    ]
    assert all(reasons(spark, texts))


def test_good_changes_and_exact_text(spark):
    texts = [
        f'{{"schema":"s","table":"t","op":"INSERT","before":null,"after":{WIDE}}}',
        '{"schema":"s","table":"t","op":"DELETE","before":{"a":"\\u00011"},"unknown":7}',
        ' {"table":"t","schema":"s","op":"UPDATE","before":{"a":1.0},"after":{"a":"x\\\\u0001y"}} ',
    ]
    rows = envelope.decode_change(frame(spark, texts)).orderBy("ev_id").collect()
    assert [r["reason"] for r in rows] == [None] * 3
    assert '"decimal":12345678901234567890.00100' in rows[0]["after"]
    assert json.loads(rows[1]["before"]) == {"a": "\u00011"} and rows[1]["after"] is None
    assert rows[2]["before"] == '{"a":1.0}' and json.loads(rows[2]["after"]) == {"a": "x\\u0001y"}


def test_reason_hides_the_payload(spark):
    assert all("secret" not in r for r in reasons(spark, ['{"secret', '{"schema":"secret"}']))


json_values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(alphabet="ab\u0001\"\\-1", max_size=4), inner, max_size=3),
    max_leaves=12,
)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(json_values, st.booleans()), min_size=20, max_size=40))
def test_tagging_round_trips_like_pythons_reader(spark, values):
    texts = [json.dumps(v, ensure_ascii=e) for v, e in values]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i bigint, t string")
    back = df.select("i", jsonx.untag(jsonx.tag(F.col("t"))).alias("u"), jsonx.tag(F.col("t")).alias("g"))
    for r in back.collect():
        assert r["u"] == texts[r["i"]]
        json.loads(r["g"])


def test_envelope_keeps_the_payload(spark):
    payload = '{"schema":"s","table":"t","op":"INSERT","after":{"n":9007199254740993,"d":12345678901234567890.12345}}'
    df = frame(spark, [payload]).withColumn("ev_id", F.lit(7))
    text = df.select(envelope.legacy_envelope(F.lit("epoch"), F.col("ev_id"), F.col("ev_data")).alias("v")).first()["v"]
    assert json.loads(text) == {"headers": {"ID": "epoch:7", "PARTITION_ID": "epoch"}, "payload": payload}
    back = envelope.parse_envelope(spark.createDataFrame([(text,)], "value string"), F.lit("epoch")).first()
    assert (back["ev_id"], back["payload"], back["envelope_reason"]) == (7, payload, None)


def test_frame_of_schema_123(spark):
    df = spark.range(1).select(envelope.frame(F.lit(123), F.encode(F.lit("body"), "UTF-8")).alias("f"))
    assert bytes(df.first()["f"]) == b"\x00\x00\x00\x00\x7b\x00body"
    back = df.select(envelope.unframe(F.col("f")).alias("u")).first()["u"]
    assert back["schema_id"] == 123 and bytes(back["body"]) == b"body"
    with pytest.raises(PySparkException):
        spark.range(1).select(envelope.frame(F.lit(0), F.encode(F.lit(""), "UTF-8"))).collect()


def test_default_partitioner(spark):
    # Published test values of the 32-bit murmur2 used by the default partitioner.
    known = {
        "21": -973932308,
        "foobar": -790332482,
        "a-little-bit-long-string": -985981536,
        "a-little-bit-longer-string": -1486304829,
        "lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971,
        "abc": 479470107,
    }
    df = spark.createDataFrame([(k,) for k in known], "k string")
    got = {r["k"]: r["p"] for r in df.select("k", envelope.partition_for(F.encode("k", "UTF-8"), 1000).alias("p")).collect()}
    assert got == {k: (v & 0x7FFFFFFF) % 1000 for k, v in known.items()}


def test_chunks_of_two(spark):
    rows = spark.createDataFrame([(1, i, 10) for i in range(1, 18)], "batch_tick bigint, ev_id bigint, size bigint")
    got = envelope.chunk_records(rows, ["batch_tick"], 2, 1 << 20)
    assert {r["ev_id"]: r["chunk"] for r in got.collect()} == {i: (i + 1) // 2 for i in range(1, 18)}
    with pytest.raises(PySparkException):
        envelope.chunk_records(rows.withColumn("size", F.lit(1 << 20).cast("bigint")), ["batch_tick"], 2, 1 << 20).collect()


ID = "123e4567-e89b-12d3-a456-426614174000"


def b64(raw):
    import base64

    return base64.b64encode(raw).decode()


def wrapper(**changes):
    headers = [{"key": "id", "value": b64(ID.encode())}, {"key": "binary", "value": b64(b"\x00\xff")}, {"key": "binary", "value": None}]
    body = {"id": ID, "key": b64(b"\x00\xff\x01"), "value": b64(bytes.fromhex("0000000180ff")), "headers": headers}
    body.update(changes)
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def test_outbox_wire_bytes_survive(spark):
    broken = wrapper().replace('"AP8B"', '"AP\\n8B"')
    for text in (wrapper(), broken, wrapper(extra=1)):
        row = outbox.decode(frame(spark, [text]), "ev_data").first()
        assert row["reason"] is None
        assert bytes(row["key"]) == b"\x00\xff\x01" and bytes(row["value"]).hex() == "0000000180ff"
        assert [(h["key"], None if h["value"] is None else bytes(h["value"])) for h in row["headers"]] == [
            ("id", ID.encode()), ("binary", b"\x00\xff"), ("binary", None)
        ]


@pytest.mark.parametrize(
    "changes",
    [
        {"headers": [{"key": "id", "value": b64(b"other")}]},
        {"headers": []},
        {"headers": ...},
        {"headers": [{"key": "id", "value": b64(ID.encode())}] * 2},
        {"headers": [{"key": "", "value": None}, {"key": "id", "value": b64(ID.encode())}]},
        {"headers": [{"key": "id", "value": b64(ID.encode())}, {"key": "k" * 256, "value": b64(b"x" * 16_200)}]},
        {"id": ...},
        {"id": ID.upper()},
        {"key": ""},
        {"key": 1234},
        {"value": None},
        {"value": True},
        {"value": "no base64!"},
    ],
)
def test_outbox_refusals(spark, changes):
    row = outbox.decode(frame(spark, [wrapper(**changes)]), "ev_data").first()
    assert row["reason"] and row["value"] is None


def test_id_header_compares_without_case(spark):
    text = wrapper(headers=[{"key": "id", "value": b64(ID.upper().encode())}])
    assert outbox.decode(frame(spark, [text]), "ev_data").first()["reason"] is None


def enqueue(spark, headers, **changes):
    row = {"stream": "orders", "id": ID, "key": bytearray(b"k"), "value": bytearray(b"v"), "headers": headers, **changes}
    df = spark.createDataFrame([tuple(row.values())], "stream string, id string, key binary, value binary, headers string")
    streams = spark.createDataFrame([("orders", "e", "t")], "name string, epoch string, topic string")
    return outbox.enqueue(df, streams).first()


def test_enqueue_adds_the_id_header_last(spark):
    row = enqueue(spark, '[{"key":"a","value":null}]')
    assert row["reason"] is None
    assert [(h["key"], h["value"]) for h in row["headers_out"]] == [("a", None), ("id", b64(ID.encode()))]


@pytest.mark.parametrize(
    "headers",
    ["{}", "null", "[1]", '[{"key":"a"}]', '[{"key":1,"value":null}]', '[{"key":"a","value":1}]', '[{"key":"a","value":"*"}]',
     '[{"key":"","value":null}]', '[{"key":"id","value":null}]', "[]]",
     json.dumps([{"key": "id", "value": b64(ID.encode())}] * 2)],
)
def test_enqueue_refusals(spark, headers):
    assert enqueue(spark, headers)["reason"]


def test_enqueue_limits(spark):
    assert enqueue(spark, "[]", key=bytearray(4097))["reason"] == "invalid key"
    assert enqueue(spark, "[]", value=bytearray(524289))["reason"] == "invalid value"
    assert enqueue(spark, "[]", stream="x")["reason"] == "unknown stream"
    big = json.dumps([{"key": "a", "value": b64(b"x" * 12_400)}])
    assert enqueue(spark, big)["reason"] == "headers too large"
    assert enqueue(spark, json.dumps([{"key": "id", "value": b64(("{" + ID.upper() + "}").encode())}]))["reason"] is None
