"""Transactional outbox: enqueue rules, wrapper, decoding, streams, key order, replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcdc.functions import codecs, jsonx
from sparkcdc.functions.text import json_quote
from sparkcdc.operators.ordered import running

# Size limits of an outbox message.
MAX_WRAPPER_BYTES = 786_432
MAX_KEY_BYTES = 4_096
MAX_VALUE_BYTES = 524_288
MAX_HEADER_KEY_BYTES = 256
MAX_HEADERS_BYTES = 16_384
MAX_TOPIC_CHARS = 249
#: A short wrapper in the spelling that ``wrap`` writes; longer ones and other spellings are read in full.
SHORT_WRAPPER_BYTES = 4096
_BASE64 = r'"(?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?"'
_OTHER_HEADER = rf'\{{"key":(?!"id")"[ !#-\[\]-~]{{1,{MAX_HEADER_KEY_BYTES}}}","value":(?:{_BASE64}|null)\}}'
SHORT_WRAPPER = (
    rf'^\{{"id":"{codecs.DELIVERY_ID[1:-1]}","key":(?!""){_BASE64},"value":(?!""){_BASE64},'
    rf'"headers":\[(?:{_OTHER_HEADER},)*+\{{"key":"id","value":{_BASE64}\}}(?:,{_OTHER_HEADER})*+\]\}}\z'
)


def header_text(headers: Column) -> Column:
    """Stored JSON text of ``array<struct<key,value>>`` with base64 values; its length counts."""
    items = F.transform(
        headers,
        lambda h: F.concat(
            F.lit('{"key": '), json_quote(h["key"]), F.lit(', "value": '), F.coalesce(json_quote(h["value"]), F.lit("null")), F.lit("}")
        ),
    )
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def _plain_uuid(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[{}-]", ""))


def enqueue(df: DataFrame, streams: DataFrame) -> DataFrame:
    """Check and complete messages ``(stream, id, key, value, headers)``, headers as JSON text.

    Adds ``headers_out`` (the array with the ``id`` header at the end when it was absent) and
    ``reason``, null for an acceptable message. Header values are base64 text or null; at most one
    ``id`` header, and it must hold the delivery id.
    """
    known = streams.select(F.col("name").alias("stream"), F.lit(True).alias("_known"))
    rows = df.join(known, "stream", "left")
    given = F.col("headers")
    entries = F.from_json(
        F.concat(F.lit("["), jsonx.tag(given), F.lit(',[{"key":"'), F.md5(given), F.lit('"}]]')),
        "array<array<struct<key:variant,value:variant>>>",
        jsonx.STRICT,
    )
    rows = jsonx.settle(rows, _entries=entries)
    end = F.try_variant_get(F.get(F.get("_entries", F.lit(1)), F.lit(0))["key"], "$", "string")
    is_array = F.coalesce((F.size("_entries") == 2) & (end == F.md5(given)), F.lit(False))
    # Read every variant once, then work on plain strings.
    texts = F.transform(
        F.get("_entries", F.lit(0)),
        lambda h: F.struct(
            jsonx.text_of(h["key"]).alias("key"), jsonx.text_of(h["value"]).alias("value"), F.is_variant_null(h["value"]).alias("empty")
        ),
    )
    rows = jsonx.settle(rows, _texts=F.when(is_array, texts)).drop("_entries")
    typed = F.transform(
        "_texts",
        lambda h: F.struct(
            jsonx.unmarked(h["key"]).alias("key"),
            jsonx.unmarked(h["value"]).alias("value"),
            (h["empty"] | jsonx.unmarked(h["value"]).isNotNull()).alias("value_ok"),
        ),
    )
    rows = jsonx.settle(rows, _h=typed).drop("_texts")
    bad_header = F.exists(
        "_h",
        lambda h: h["key"].isNull()
        | ~F.octet_length(F.coalesce(h["key"], F.lit(""))).between(1, MAX_HEADER_KEY_BYTES)
        | ~h["value_ok"]
        | (h["value"].isNotNull() & codecs.unb64(h["value"]).isNull()),
    )
    ids = F.filter("_h", lambda h: h["key"] == "id")
    wrong_id = F.exists(
        ids,
        lambda h: ~F.coalesce(_plain_uuid(F.decode(codecs.unb64(h["value"]), "UTF-8")) == _plain_uuid(F.col("id")), F.lit(False)),
    )
    kept = F.transform("_h", lambda h: F.struct(h["key"].alias("key"), h["value"].alias("value")))
    own = F.struct(F.lit("id").alias("key"), codecs.b64(codecs.utf8(F.col("id"))).alias("value"))
    complete = F.when(F.size(ids) == 0, F.concat(kept, F.array(own))).otherwise(kept)
    reason = (
        F.when(F.col("_known").isNull(), F.lit("unknown stream"))
        .when(~F.coalesce(F.col("id").rlike(codecs.DELIVERY_ID), F.lit(False)), F.lit("invalid id"))
        .when(~F.coalesce(F.octet_length("key").between(1, MAX_KEY_BYTES), F.lit(False)), F.lit("invalid key"))
        .when(~F.coalesce(F.octet_length("value").between(1, MAX_VALUE_BYTES), F.lit(False)), F.lit("invalid value"))
        .when(F.col("_h").isNull(), F.lit("headers are not an array"))
        .when(bad_header, F.lit("invalid header"))
        .when(wrong_id, F.lit("id header differs"))
        .when(F.size(ids) > 1, F.lit("duplicate id header"))
        .when(F.octet_length(header_text(complete)) > MAX_HEADERS_BYTES, F.lit("headers too large"))
    )
    rows = jsonx.settle(rows, reason=reason)
    return rows.select(*df.columns, F.when(F.col("reason").isNull(), complete).alias("headers_out"), "reason")


def accept(checked: DataFrame) -> DataFrame:
    """Fail the write on the first message with a reason."""
    return checked.withColumn(
        "id", F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("string")).otherwise(F.col("id"))
    )


def wrap(id_: Column, key: Column, value: Column, headers: Column) -> Column:
    """Wrapper JSON: base64 key and value, headers in order."""
    return F.to_json(
        F.struct(id_.alias("id"), codecs.b64(key).alias("key"), codecs.b64(value).alias("value"), headers.alias("headers")),
        {"ignoreNullFields": "false"},
    )


def decode(df: DataFrame, raw: str) -> DataFrame:
    """Adds ``id, key, value, headers`` (bytes) and ``reason``. Exactly one ``id`` header must equal the
    id, ignoring case; other headers keep order, repetition and nulls. Unknown fields are ignored.

    A wrapper in the spelling of ``SHORT_WRAPPER`` whose id header is its id is valid by it and read at once."""
    text = F.col(raw)
    short = (F.octet_length(text) <= SHORT_WRAPPER_BYTES) & text.rlike(SHORT_WRAPPER)
    message = F.from_json(text, "struct<id:string,key:string,value:string,headers:array<struct<key:string,value:string>>>")
    rows = jsonx.settle(df, _message=F.when(short, message))
    message = F.col("_message")
    own = F.contains(text, F.concat(F.lit('{"key":"id","value":"'), F.base64(message["id"].cast("binary")), F.lit('"}')))
    rows = rows.withColumn("_message", F.when(own, message))
    others = [c for c in df.columns if c not in ("id", "key", "value", "headers")]
    rows = _decode_any(rows.withColumn("_odd", F.when(message.isNull(), text)), "_odd")
    read = {
        "id": message["id"], "key": F.unbase64(message["key"]), "value": F.unbase64(message["value"]),
        "headers": F.transform(message["headers"], lambda h: F.struct(h["key"].alias("key"), F.unbase64(h["value"]).alias("value"))),
    }
    shown = [F.when(message.isNull(), F.col(n)).otherwise(c).alias(n) for n, c in read.items()]
    return rows.select(*others, *shown, F.when(message.isNull(), F.col("reason")).alias("reason"))


def _decode_any(df: DataFrame, raw: str) -> DataFrame:
    """``decode`` of any spelling, by one strict parse."""
    text = F.col(raw)
    shape = "struct<id:variant,key:variant,value:variant,headers:array<struct<key:variant,value:variant>>,_end:string>"
    rows = jsonx.settle(df, _entries=jsonx.strict_object(text, shape))
    message = F.get("_entries", F.lit(0))
    texts = F.transform(
        message["headers"],
        lambda h: F.struct(
            jsonx.text_of(h["key"]).alias("key"), jsonx.text_of(h["value"]).alias("t"), jsonx.is_null_or_missing(h["value"]).alias("empty")
        ),
    )
    rows = jsonx.settle(
        rows,
        _unreadable=~jsonx.only(F.col("_entries"), F.get("_entries", F.lit(1))["_end"], text),
        _texts=texts,
        **{"_" + n: jsonx.text_of(message[n]) for n in ("id", "key", "value")},
    ).drop("_entries")
    bytes_of = F.transform(
        "_texts",
        lambda h: F.struct(
            jsonx.unmarked(h["key"]).alias("key"), codecs.unb64(jsonx.unmarked(h["t"])).alias("value"), h["empty"].alias("empty")
        ),
    )
    rows = jsonx.settle(
        rows.withColumnsRenamed({"_key": "_key64", "_value": "_value64", "_id": "_id_text"}),
        _id=jsonx.unmarked(F.col("_id_text")),
        _key=codecs.unb64(jsonx.unmarked(F.col("_key64"))),
        _value=codecs.unb64(jsonx.unmarked(F.col("_value64"))),
        _h=bytes_of,
    )
    bad_header = F.exists(
        "_h",
        lambda h: ~F.octet_length(F.coalesce(h["key"], F.lit(""))).between(1, MAX_HEADER_KEY_BYTES)
        | (~h["empty"] & h["value"].isNull()),
    )
    ids = F.filter("_h", lambda h: h["key"] == "id")
    wrong_id = F.exists(
        ids, lambda h: ~F.coalesce(F.lower(F.decode(h["value"], "UTF-8")) == F.lower(F.col("_id")), F.lit(False))
    )
    header_bytes = F.aggregate(
        "_h", F.lit(0), lambda acc, h: acc + F.octet_length(h["key"]) + F.coalesce(F.octet_length(h["value"]), F.lit(0))
    )
    reason = (
        F.when(F.octet_length(text) > MAX_WRAPPER_BYTES, F.lit("wrapper too large"))
        .when(F.col("_unreadable"), F.lit("not a JSON object"))
        .when(~F.coalesce(F.col("_id").rlike(codecs.DELIVERY_ID), F.lit(False)), F.lit("invalid id"))
        .when(~F.coalesce(F.octet_length("_key").between(1, MAX_KEY_BYTES), F.lit(False)), F.lit("invalid key"))
        .when(~F.coalesce(F.octet_length("_value").between(1, MAX_VALUE_BYTES), F.lit(False)), F.lit("invalid value"))
        .when(F.coalesce(bad_header, F.lit(False)), F.lit("invalid header"))
        .when(F.coalesce(wrong_id, F.lit(False)), F.lit("id header differs"))
        .when(F.coalesce(F.size(ids), F.lit(0)) != 1, F.lit("id header missing or repeated"))
        .when(header_bytes > MAX_HEADERS_BYTES, F.lit("headers too large"))
    )
    rows = jsonx.settle(rows, _reason=reason)
    good = F.col("_reason").isNull()
    headers = F.transform("_h", lambda h: F.struct(h["key"].alias("key"), h["value"].alias("value")))
    return rows.select(
        *[c for c in df.columns if c not in ("id", "key", "value", "headers")],
        F.when(good, F.col("_id")).alias("id"),
        F.when(good, F.col("_key")).alias("key"),
        F.when(good, F.col("_value")).alias("value"),
        F.when(good, headers).alias("headers"),
        F.col("_reason").alias("reason"),
    )


def check_streams(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """``requests(name, epoch, topic)`` with a reason: bad name or topic, a name or epoch asked for
    twice or registered already. Registration is immutable."""
    names = existing.select("name", F.lit(True).alias("_name_taken"))
    epochs = existing.select("epoch", F.lit(True).alias("_epoch_taken"))
    per_name = requests.groupBy("name").agg(F.count("*").alias("_names"))
    per_epoch = requests.groupBy("epoch").agg(F.count("*").alias("_epochs"))
    rows = requests.join(names, "name", "left").join(epochs, "epoch", "left").join(per_name, "name", "left").join(per_epoch, "epoch", "left")
    reason = (
        F.when(~F.coalesce(F.col("name").rlike(codecs.STREAM_NAME), F.lit(False)), F.lit("invalid name"))
        .when(~F.coalesce(F.length("topic").between(1, MAX_TOPIC_CHARS), F.lit(False)), F.lit("invalid topic"))
        .when(F.col("_name_taken") | (F.col("_names") > 1), F.lit("name taken"))
        .when(F.col("_epoch_taken") | (F.col("_epochs") > 1), F.lit("epoch taken"))
    )
    return rows.select("name", "epoch", "topic", reason.alias("reason"))


def key_order_violations(assigned: DataFrame, by: Sequence[str], width: int = 65536) -> DataFrame:
    """Per key and batch: ids that an earlier batch of the same key has already passed.

    Events shrink to one row per (key, batch) first, so a hot key costs one row per tick.
    """
    per_batch = assigned.where(F.col("batch_tick").isNotNull()).groupBy(*by, "batch_tick").agg(
        F.min("ev_id").alias("lowest_id"), F.max("ev_id").alias("_top")
    )
    marked = running(per_batch, by, "batch_tick", {"passed_id": ("max", F.col("_top"))}, width)
    return marked.where(F.col("passed_id") > F.col("lowest_id")).drop("_top")


def route_mismatch(configured: DataFrame, registered: DataFrame) -> DataFrame:
    """Streams whose configured topic is not the registered one, or that nobody registered."""
    other = registered.select("name", F.col("topic").alias("registered_topic"))
    joined = configured.join(other, "name", "left")
    return joined.where(~F.col("topic").eqNullSafe(F.col("registered_topic")))


def replay_facts(facts: DataFrame, ids: DataFrame, streams: DataFrame) -> DataFrame:
    """Chosen retained messages, enqueued again with the same id, key, value and headers."""
    return accept(enqueue(facts.join(ids.select("id").distinct(), "id", "left_semi"), streams))
