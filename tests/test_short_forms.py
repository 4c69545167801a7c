"""Changes and wrappers in the spelling that capture and the outbox write, read without a full parse."""

import base64
import json

from pyspark.sql import functions as F

from sparkcdc.functions.text import json_quote_exact
from sparkcdc.operators import envelope, outbox
from sparkcdc.plans import stream_queries
from sparkcdc.streaming import relay

UUID = "00000000-0000-0000-0000-0000000000ab"


def b64(text):
    return base64.b64encode(text.encode()).decode()


def change(after='{"k": 76}', before="null", op="INSERT", schema="s", table="t"):
    return f'{{"schema":"{schema}","table":"{table}","op":"{op}","before":{before},"after":{after}}}'


SHORT = [
    change(), change("{}"), change('{"a":1,"b":-1.5e+3,"c":true,"d":null,"e":"x y"}'), change('{"a":1, "aa":2, "b":"a"}'), change('{"a":"1","b":"{0"}'.replace("{0", "0")),
    change('{"a":2}', '{"a":1}', "UPDATE"), change("null", '{"a":1}', "DELETE"), change(schema="public x", table="T-1"), change('{"n":123456789012345678901234567890}'),
]
ODD = [
    None, "", "null", change() + " ", change() + "\n", change() + "{}", " " + change(), change('{"k":1,"k":2}'), change('{"k":1,"b":"}","k":2}'), change('{"k":1,"b":"{","k":2}'),
    change('{"k" :1,"k":2}'), change('{"k":01}'), change('{"k":1,}'), change('{"k":1 "b":2}'), change('{,"k":1}'), change('{"k":+1}'), change('{"k":1.}'), change('{"k":NaN}'),
    change('{"k":[1]}'), change('{"k":{"k":1}}'), change('{"k":"\\u0001"}'), change('{"k":"\\""}'), change('{"k":"é"}'), change("null"), change('{"a":1}', '{"a":1}'),
    change(op="insert"), change(op="DELETE"), change('{"a":1}', op="UPDATE"), change(schema=""), change(table=""), change(schema="a\\u0062"), change(schema="\\u00015"),
    change().replace('"s"', "5"), change().replace("}}", "}"), change("[]"), change("5"), change('{"' + "k" * 600 + '":1}'), change('{"k":' + "1" * 1200 + "}"),
    change().replace('"op"', '"table":"u","op"'), change().replace('"op":"INSERT"', '"op":"INSERT","op":"DELETE"'), change('{"":1,"":2}'), change("{'k':1}"),
]


def test_short_changes_are_what_a_full_parse_says(spark):
    texts = SHORT + ODD
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "ev_id bigint, ev_data string").repartition(3)
    names = ["ev_id", "schema_name", "table_name", "op", "reason"]
    want = envelope.decode_change(rows).select(names).orderBy("ev_id").collect()
    assert envelope.check_change(rows).select(names).orderBy("ev_id").collect() == want
    assert [r["reason"] for r in want[: len(SHORT)]] == [None] * len(SHORT)
    within = F.octet_length("ev_data") <= envelope.SHORT_CHANGE_BYTES
    assert rows.where(within & F.col("ev_data").rlike(envelope.SHORT_CHANGE)).count() == len(SHORT)


def header(key, value):
    return f'{{"key":{json.dumps(key)},"value":{"null" if value is None else json.dumps(value)}}}'


def wrapper(id_=UUID, key=b64("k"), value=b64("value"), headers=None):
    headers = [header("id", b64(UUID))] if headers is None else headers
    return f'{{"id":"{id_}","key":"{key}","value":"{value}","headers":[{",".join(headers)}]}}'


OWN = header("id", b64(UUID))
WRAPPERS = [
    wrapper(), wrapper(headers=[header("a", None), OWN, header("a", ""), header("a", b64("x"))]), wrapper(value="QR=="), wrapper(value="QUI="), wrapper(value="QUJD" * 40),
    None, "", wrapper() + "x", wrapper() + "\n", wrapper(key=""), wrapper(value=""), wrapper(value="A"), wrapper(value="=AAA"), wrapper(value="AA=="*2), wrapper(value="true"),
    wrapper().replace(f'"{b64("k")}"', "true"), wrapper().replace(f'"{b64("k")}"', "1234"), wrapper(headers=[]), wrapper(headers=[OWN, OWN]), wrapper(headers=[header("id", b64("x"))]),
    wrapper(headers=[header("id", b64(UUID.upper()))]), wrapper(id_=UUID.upper()), wrapper(headers=[OWN, header("", "")]), wrapper(headers=[OWN, header("k" * 256, "")]),
    wrapper(headers=[OWN, header("k" * 257, "")]), wrapper(headers=[header("id", None), OWN]), wrapper(headers=[header("aé", ""), OWN]), wrapper(headers=[header("a", "?"), OWN]),
    wrapper(value="QUJD" * 2000), wrapper(headers=[OWN, '{"key":"a","value":1}']), wrapper(headers=[OWN, '{"key":"a"}']), wrapper(headers=[header("a", b64("x"))]),
    wrapper().replace('"headers"', '"more":1,"headers"'), wrapper(headers=[header("a", b64("b")), header("id", b64("other"))]), wrapper().replace(",", ", "),
]


def test_short_wrappers_are_what_a_full_parse_says(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(WRAPPERS)], "ev_id bigint, ev_data string").repartition(3)
    names = ["ev_id", "id", "key", "value", "headers", "reason"]
    want = outbox._decode_any(rows, "ev_data").select(names).orderBy("ev_id").collect()
    assert outbox.decode(rows, "ev_data").select(names).orderBy("ev_id").collect() == want
    assert [r["reason"] for r in want[:5]] == [None] * 5
    assert rows.where(F.col("ev_data").rlike(outbox.SHORT_WRAPPER)).count() >= 5


def test_what_the_streams_relay_is_short(spark):
    folder = "/root/testdata/sf0.001"
    for events, form in ((stream_queries.change_events, envelope.SHORT_CHANGE), (stream_queries.outbox_events, outbox.SHORT_WRAPPER)):
        assert events(spark, folder).where(~F.col("ev_data").rlike(form)).count() == 0


def test_quoting_of_every_short_text(spark):
    texts = [chr(c) for c in range(1, 0x180)] + [f"a{chr(c)}b\\{chr(c)}" for c in range(1, 0x80)] + ["", '"\\"', "\\u0041", " x", "\U0001f600"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", json_quote_exact(F.col("t")).alias("q")).collect()
    for r in got:
        assert json.loads(r["q"]) == r["t"]
        assert not set("<>&  \n") & set(r["q"])


def test_a_batch_published_again_is_encoded_once(spark, tmp_path, monkeypatch):
    encoded = spark.sparkContext.accumulator(0)
    plain = relay.cdc_encoder

    @F.udf("string")
    def seen(text):
        encoded.add(1)
        return text

    def counting(*args):
        encode = plain(*args)
        return lambda batch: encode(batch.withColumn("ev_data", seen("ev_data")))

    monkeypatch.setattr(stream_queries.relay, "cdc_encoder", counting)
    folder = "/root/testdata/sf0.001"
    n = stream_queries.relay_fenced_replay_q(spark, folder).count()
    assert (n, encoded.value) == (spark.read.parquet(f"{folder}/events.parquet").count(),) * 2
