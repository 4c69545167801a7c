"""Change envelopes: decoding, poison, typed images, framing, routing, chunking, partitions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcdc.functions import codecs, jsonx
from sparkcdc.functions.text import json_quote_exact
from sparkcdc.operators.capture import MAX_CHANGE_BYTES
from sparkcdc.operators.segments import Measure, greedy_cuts

# Limits and patterns of the wire format.
MAX_RECORD_BYTES = (1 << 20) - 1024
HEADER_OVERHEAD = 10
MAX_ROUTES = 16
MAX_SCHEMA_ID = (1 << 31) - 1
OPERATIONS = {"INSERT": 1, "UPDATE": 2, "DELETE": 3}
#: A short change in the spelling that capture writes, with flat images of printable ASCII; longer ones are read in full.
SHORT_CHANGE_BYTES = 512


def _short_change() -> str:
    names = iter(range(4))

    def image() -> str:
        # No field name comes twice: a braceless rest that holds the name again is not matched.
        k = f"k{next(names)}"
        value = r'(?:"[ !#-\[\]-z|~]*+"|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?|true|false|null)'
        pair = rf'"(?<{k}>[ !#-\[\]-z|~]++)":(?![^{{}}]*"\k<{k}>":) ?{value}'
        return rf"\{{(?:{pair}(?:, ?(?!\}})|(?=\}})))*+\}}"

    word = r'"[ !#-\[\]-~]++"'
    images = [f'INSERT","before":null,"after":{image()}', f'UPDATE","before":{image()},"after":{image()}', f'DELETE","before":{image()},"after":null']
    return rf'^\{{"schema":{word},"table":{word},"op":"(?:{"|".join(images)})\}}\z'


SHORT_CHANGE = _short_change()


def check_change(df: DataFrame, raw: str = "ev_data") -> DataFrame:
    """What ``decode_change`` adds without the images, for a relay that passes the change on as it came: ``schema_name,
    table_name, op`` and ``reason``. A change in the spelling of ``SHORT_CHANGE`` is valid by it, any other is decoded."""
    text = F.col(raw)
    short = (F.octet_length(text) <= SHORT_CHANGE_BYTES) & text.rlike(SHORT_CHANGE)
    rows = jsonx.settle(df, _words=F.when(short, F.split(text, '"', 13)))
    words = F.col("_words")
    others = [c for c in df.columns if c not in ("op", "before", "after")]
    rows = decode_change(rows.withColumn("_odd", F.when(words.isNull(), text)), "_odd")
    places = {"schema_name": 3, "table_name": 7, "op": 11}
    shown = [F.when(words.isNull(), F.col(n)).otherwise(F.get(words, F.lit(at))).alias(n) for n, at in places.items()]
    return rows.select(*others, *shown, F.when(words.isNull(), F.col("reason")).alias("reason"))


def decode_change(df: DataFrame, raw: str = "ev_data") -> DataFrame:
    """Adds ``schema_name, table_name, op, before, after`` (image text, numbers exact) and ``reason``,
    null for a valid change. Nothing of a payload ever appears in a reason.

    The change is one JSON object with non-empty schema and table. INSERT has only an after image,
    DELETE only a before image, UPDATE both; a JSON null counts as no image. Unknown fields are
    ignored, a repeated field keeps its last value, an image that repeats a field is invalid.
    """
    text = F.col(raw)
    shape = "struct<schema:variant,table:variant,op:variant,before:variant,after:variant,_end:string>"
    rows = jsonx.settle(df, _entries=jsonx.strict_object(text, shape))
    change = F.get("_entries", F.lit(0))
    words = ("schema", "table", "op")

    def image_token(n: str) -> Column:
        return F.when(~jsonx.is_null_or_missing(change[n]), F.to_json(change[n]))

    rows = jsonx.settle(
        rows,
        _is_object=jsonx.only(F.col("_entries"), F.get("_entries", F.lit(1))["_end"], text),
        **{f"_{n}": F.try_variant_get(change[n], "$", "string") for n in words},
        **{f"_{n}_kind": F.schema_of_variant(change[n]) for n in words},
        _before=image_token("before"),
        _after=image_token("after"),
    ).drop("_entries")

    def word(n: str) -> Column:
        return F.when(F.col(f"_{n}_kind") == "STRING", jsonx.unmarked(F.col("_" + n)))

    odd = ~F.coalesce(F.col("_op_kind") == "VOID", F.lit(True)) & word("op").isNull()

    def absent(n: str) -> Column:
        return F.col("_" + n).isNull()

    def image(n: str) -> Column:
        return F.coalesce(F.startswith(F.col("_" + n), F.lit("{")), F.lit(False))

    op = word("op")
    named = ~odd & (F.coalesce(word("schema"), F.lit("")) != "") & (F.coalesce(word("table"), F.lit("")) != "")
    fits = (
        ((op == "INSERT") & absent("before") & image("after"))
        | ((op == "UPDATE") & image("before") & image("after"))
        | ((op == "DELETE") & image("before") & absent("after"))
    )
    reason = (
        F.when(F.octet_length(text) > MAX_CHANGE_BYTES, F.lit("change too large"))
        .when(text.isNull() | ~F.col("_is_object"), F.lit("not a JSON object"))
        .when(~named, F.lit("schema or table missing"))
        .when(~F.coalesce(fits, F.lit(False)), F.lit("operation and images do not fit"))
    )
    shown = [
        word("schema").alias("schema_name"),
        word("table").alias("table_name"),
        op.alias("op"),
        F.when(image("before"), jsonx.untag(F.col("_before"))).alias("before"),
        F.when(image("after"), jsonx.untag(F.col("_after"))).alias("after"),
    ]
    others = [F.col(c) for c in df.columns if c not in ("op", "before", "after")]
    return jsonx.settle(rows, _reason=reason).select(*others, *shown, F.col("_reason").alias("reason"))


def poison_batches(decoded: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per batch whether any record blocks it, with the reason of its first bad record."""
    bad = F.col("reason").isNotNull()
    return decoded.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(bad).alias("bad"),
        F.min(F.when(bad, F.struct("ev_id", "reason"))).alias("_first"),
    ).select(*by, "n", "bad", F.col("_first")["ev_id"].alias("first_bad_id"), F.col("_first")["reason"].alias("reason"))


def legacy_envelope(epoch: Column, ev_id: Column, payload: Column) -> Column:
    """JSON envelope with the payload text unchanged inside it."""
    good = F.when(ev_id < 1, F.raise_error(F.lit("invalid source record")).cast("string")).otherwise(ev_id.cast("string"))
    return F.concat(
        F.lit('{"headers":{"ID":'), json_quote_exact(F.concat(epoch, F.lit(":"), good)), F.lit(',"PARTITION_ID":'), json_quote_exact(epoch),
        F.lit('},"payload":'), json_quote_exact(payload), F.lit("}"),
    )


def parse_envelope(df: DataFrame, epoch: Column, value: str = "value", progress_key: str = "progress") -> DataFrame:
    """Adds ``kind`` (data, boundary), ``ev_id``, ``payload``, ``boundary`` and ``envelope_reason``.

    Only the known fields are allowed at either level. A data record carries the epoch and an id that is
    the epoch, a colon and a canonical positive decimal. A boundary has version 1, the same epoch and a time.
    """
    text = F.col(value).cast("string")
    rows = jsonx.settle(df, _entries=jsonx.strict_object(text, "map<string,variant>"))
    fields = F.get("_entries", F.lit(0))
    known = F.size(F.array_except(F.map_keys(fields), F.array(F.lit("headers"), F.lit("payload"), F.lit(progress_key)))) == 0
    end = F.try_variant_get(F.try_element_at(F.get("_entries", F.lit(1)), F.lit("_end")), "$", "string")
    inner = F.try_variant_get(F.try_element_at(fields, F.lit(progress_key)), "$", "map<string,variant>")
    inner_known = F.size(F.array_except(F.map_keys(inner), F.array(F.lit("version"), F.lit("source_epoch"), F.lit("committed_before")))) == 0
    rows = jsonx.settle(
        rows,
        _known=jsonx.only(F.col("_entries"), end, text) & known,
        _inner_known=inner_known,
        _headers=F.try_variant_get(F.try_element_at(fields, F.lit("headers")), "$", "map<string,string>"),
        _payload=jsonx.word_of(F.try_element_at(fields, F.lit("payload"))),
        _progress=F.when(
            inner.isNotNull(),
            F.struct(
                jsonx.number_of(F.try_element_at(inner, F.lit("version"))).alias("version"),
                jsonx.word_of(F.try_element_at(inner, F.lit("source_epoch"))).alias("source_epoch"),
                jsonx.word_of(F.try_element_at(inner, F.lit("committed_before"))).alias("committed_before"),
            ),
        ),
    )
    progress, headers, payload = F.col("_progress"), F.col("_headers"), F.col("_payload")
    ident = F.try_element_at(headers, F.lit("ID"))
    prefix = F.concat(epoch, F.lit(":"))
    suffix = F.when(F.startswith(ident, prefix), F.substr(ident, F.length(prefix) + 1))
    ev_id = F.when(suffix.rlike(codecs.POSITIVE_DECIMAL), suffix.try_cast("bigint"))
    stamp = progress["committed_before"]
    boundary = F.when(stamp.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"), stamp.try_cast("timestamp"))
    reason = (
        F.when(F.octet_length(value) > (1 << 20), F.lit("record too large"))
        .when(text.isNull() | ~F.coalesce(F.col("_known"), F.lit(False)), F.lit("malformed envelope"))
        .when(
            progress.isNotNull(),
            F.when(
                payload.isNotNull() | headers.isNotNull() | ~F.coalesce(F.col("_inner_known"), F.lit(False)), F.lit("malformed boundary")
            )
            .when(~F.coalesce(progress["version"] == "1", F.lit(False)), F.lit("unknown version"))
            .when(~F.coalesce(progress["source_epoch"] == epoch, F.lit(False)), F.lit("other epoch"))
            .when(boundary.isNull(), F.lit("missing boundary")),
        )
        .when(payload.isNull(), F.lit("missing payload"))
        .when(~F.coalesce(F.try_element_at(headers, F.lit("PARTITION_ID")) == epoch, F.lit(False)), F.lit("other epoch"))
        .when(ev_id.isNull(), F.lit("invalid id"))
    )
    good = reason.isNull()
    return rows.select(
        *df.columns,
        F.when(progress.isNotNull(), F.lit("boundary")).otherwise(F.lit("data")).alias("kind"),
        F.when(good, ev_id).alias("ev_id"),
        F.when(good, payload).alias("payload"),
        F.when(good, boundary).alias("boundary"),
        reason.alias("envelope_reason"),
    )


def image_reason(raw: Column) -> Column:
    """Why a row image cannot be typed, or null; empty text and JSON null are no image, not an error."""
    absent = raw.isNull() | raw.rlike(r"^\s*(null)?\s*$")
    tagged = jsonx.tag(raw)
    return F.when(~absent, F.when(~jsonx.is_object(raw), F.lit("not a JSON object")).when(jsonx.too_deep(tagged), F.lit("nesting too deep")))


def typed_image(df: DataFrame, raw: str) -> DataFrame:
    """One row per field of the image: ``field, kind, bool, string, number_text, json``.

    Number text is exactly what the source wrote. A field holding null is present with kind null; a
    missing field has no row. Objects and arrays stay JSON text with exact numbers.
    """
    text = F.col(raw)
    present = df.where(text.isNotNull() & ~text.rlike(r"^\s*(null)?\s*$"))
    rows = jsonx.settle(present, _entries=jsonx.strict_object(text, "map<string,variant>"))
    end = F.try_variant_get(F.try_element_at(F.get("_entries", F.lit(1)), F.lit("_end")), "$", "string")
    good = jsonx.only(F.col("_entries"), end, text)
    deep = F.when(good, jsonx.too_deep(jsonx.tag(text)))
    reason = F.when(~good, F.lit("not a JSON object")).when(deep, F.lit("nesting too deep"))
    fields = F.when(reason.isNull(), F.get("_entries", F.lit(0)))
    checked = F.when(reason.isNotNull(), F.raise_error(reason).cast("map<string,variant>")).otherwise(fields)
    rows = rows.select(*df.columns, F.explode(checked).alias("field", "_v"))
    rows = jsonx.settle(rows, _t=F.coalesce(F.to_json("_v"), F.lit("null")))
    kind = jsonx.kind_of(F.col("_t"))
    return rows.select(
        *df.columns,
        "field",
        kind.alias("kind"),
        F.when(kind == "bool", F.col("_t") == "true").alias("bool"),
        F.when(kind == "string", jsonx.word_of(F.col("_v"))).alias("string"),
        F.when(kind == "number", jsonx.number_of(F.col("_v"))).alias("number_text"),
        F.when(kind.isin("object", "array"), jsonx.untag(F.col("_t"))).alias("json"),
    )


def cdc_record(decoded: DataFrame, epoch: Column, ev_id: str = "ev_id") -> DataFrame:
    """The version-1 record of a decoded change as a struct; images stay exact JSON text."""
    operation = F.col("op")
    numbers = F.when(operation == "INSERT", 1).when(operation == "UPDATE", 2).when(operation == "DELETE", 3)
    known = F.when(F.col(ev_id) < 1, F.raise_error(F.lit("invalid source record")).cast("bigint")).otherwise(F.col(ev_id).cast("bigint"))
    change = F.struct(
        known.alias("event_id"),
        F.col("schema_name").alias("schema"),
        F.col("table_name").alias("table"),
        numbers.alias("operation"),
        F.col("before"),
        F.col("after"),
    )
    record = F.struct(F.lit(1).alias("version"), epoch.alias("source_epoch"), change.alias("change"))
    return decoded.withColumn("record", record)


def frame(schema_id: Column, body: Column) -> Column:
    """Wire frame: zero byte, schema id as 4 big-endian bytes, zero byte (first message), body."""
    bad = (schema_id < 1) | (schema_id > MAX_SCHEMA_ID) | schema_id.isNull()
    head = F.when(bad, F.raise_error(F.lit("invalid schema id")).cast("binary")).otherwise(codecs.int4_bytes(schema_id))
    return F.concat(F.unhex(F.lit("00")), head, F.unhex(F.lit("00")), body)


def unframe(raw: Column) -> Column:
    """``{schema_id, body}`` of a frame; null when it is not one."""
    head = F.hex(F.substring(raw, 1, 6))
    good = head.rlike("^00[0-7][0-9A-F]{7}00$") & (F.substring(head, 3, 8) != "00000000")
    number = F.conv(F.substring(head, 3, 8), 16, 10).cast("bigint")
    return F.when(good, F.struct(number.alias("schema_id"), F.substr(raw, F.lit(7)).alias("body")))


def contract_check(topics: DataFrame, registry: DataFrame, schema_text: str) -> DataFrame:
    """``(topic, schema_id, reason)``: the subject ``<topic>-value`` must hold exactly this schema under a
    usable id. ``registry(subject, schema_text, id)``; nothing is registered on the way."""
    subject = F.concat(F.col("topic"), F.lit("-value"))
    usable = registry.where(F.col("schema_text") == schema_text).select(F.col("subject").alias("_s"), "id")
    joined = topics.select("topic").distinct().join(usable, subject == F.col("_s"), "left")
    good = F.col("id").between(1, MAX_SCHEMA_ID)
    best = joined.groupBy("topic").agg(F.min(F.when(good, F.col("id"))).alias("schema_id"), F.count("_s").alias("_n"))
    reason = F.when(F.col("schema_id").isNull(), F.when(F.col("_n") > 0, F.lit("id out of range")).otherwise(F.lit("not registered")))
    return best.select("topic", "schema_id", reason.alias("reason"))


def route_changes(changes: DataFrame, routes: DataFrame | None, default_topic: str | None = None) -> DataFrame:
    """Adds ``topic``. With routes, a schema without one is a reason that blocks its batch."""
    if routes is None:
        return changes.withColumn("topic", F.lit(default_topic))
    joined = changes.join(routes.select(F.col("schema").alias("schema_name"), "topic"), "schema_name", "left")
    reason = F.when(F.col("topic").isNull(), F.lit("schema has no route"))
    if "reason" in changes.columns:
        reason = F.coalesce(F.col("reason"), reason)
    others = [c for c in changes.columns if c != "reason"]
    return joined.select(*others, "topic", reason.alias("reason"))


def check_routes(routes: DataFrame, source: str = "source") -> DataFrame:
    """Problems per source of ``(source, schema, topic)`` routes."""
    per_topic = routes.groupBy(source, "topic").agg(
        F.count("*").alias("_n"),
        F.count_if(~F.coalesce(F.col("schema").rlike(codecs.SCHEMA_NAME), F.lit(False))).alias("_bad"),
    )
    return per_topic.groupBy(source).agg(
        F.sum("_n").alias("routes"),
        F.sum("_bad").alias("bad_names"),
        F.coalesce(F.sum(F.when(F.coalesce(F.col("topic"), F.lit("")) == "", F.col("_n"))), F.lit(0)).alias("empty_topics"),
        F.count_if((F.col("_n") > 1) & (F.coalesce(F.col("topic"), F.lit("")) != "")).alias("shared_topics"),
    ).withColumn(
        "valid",
        (F.col("routes") <= MAX_ROUTES) & (F.col("bad_names") == 0) & (F.col("empty_topics") == 0) & (F.col("shared_topics") == 0),
    )


def record_size(key: Column, value: Column, headers: Column | None = None) -> Column:
    """Bytes a record counts against a chunk."""
    size = F.coalesce(F.octet_length(key), F.lit(0)) + F.coalesce(F.octet_length(value), F.lit(0))
    if headers is not None:
        size = size + F.coalesce(
            F.aggregate(
                headers,
                F.lit(0),
                lambda acc, h: acc + F.octet_length(h["key"]) + F.coalesce(F.octet_length(h["value"]), F.lit(0)) + HEADER_OVERHEAD,
            ),
            F.lit(0),
        )
    return size.cast("bigint")


def chunk_records(records: DataFrame, by: Sequence[str], batch: int, batch_bytes: int, size: str = "size") -> DataFrame:
    """Adds ``chunk``: records in id order, a new chunk when the open one holds ``batch`` records or
    would pass ``batch_bytes``. A record over the wire limit is an error, never cut."""
    rows = records.withColumn("_one", F.lit(1).cast("bigint"))
    limits = [Measure("_one", batch, running=True), Measure(size, batch_bytes, running=True)]
    cut = greedy_cuts(rows, by, "ev_id", limits, "chunk").drop("_one", "chunk_start")
    # Once, on the result: the cutting reads its input more than once.
    checked = F.when(
        F.col(size) > MAX_RECORD_BYTES, F.raise_error(F.lit("encoded record exceeds the byte limit")).cast("bigint")
    ).otherwise(F.col("chunk"))
    return cut.withColumn("chunk", checked)


def partition_for(key: Column, partitions: int) -> Column:
    """Partition the default keyed partitioner picks: murmur2 of the key bytes, sign bit cleared."""
    @F.pandas_udf("int")
    def assign(keys: pd.Series) -> pd.Series:
        m, mask = np.uint64(0x5BD1E995), np.uint64(0xFFFFFFFF)
        out = pd.Series(np.zeros(len(keys), dtype="int32"), index=keys.index).astype("Int32")
        out[keys.isna()] = pd.NA
        lengths = keys.dropna().map(len)
        for n, group in lengths.groupby(lengths):
            n = int(n)
            raw = np.frombuffer(b"".join(keys[group.index]), dtype=np.uint8).reshape(len(group), n).astype(np.uint64)
            h = np.full(len(group), np.uint64(0x9747B28C ^ n), dtype=np.uint64)
            for i in range(0, n - n % 4, 4):
                k = raw[:, i] | raw[:, i + 1] << np.uint64(8) | raw[:, i + 2] << np.uint64(16) | raw[:, i + 3] << np.uint64(24)
                k = k * m & mask
                k = (k ^ (k >> np.uint64(24))) * m & mask
                h = (h * m & mask) ^ k
            tail = n - n % 4
            if n % 4:
                for j in range(n % 4 - 1, -1, -1):
                    h ^= raw[:, tail + j] << np.uint64(8 * j)
                h = h * m & mask
            h = (h ^ (h >> np.uint64(13))) * m & mask
            h ^= h >> np.uint64(15)
            out[group.index] = ((h & np.uint64(0x7FFFFFFF)) % np.uint64(partitions)).astype("int32")
        return out

    return assign(key)
