"""Envelope, routing and outbox queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcdc.functions import codecs
from sparkcdc.operators import envelope, outbox
from sparkcdc.plans import fixtures as fx
from sparkcdc.plans.batch_queries import assigned
from sparkcdc.plans.registry import query
from sparkcdc.session import dealt

# How each order's change payload is spoiled, by o_orderkey % 16; None is the good form.
AFTER = '{"o_orderkey":%s,"amount":12345678901234567890.00100,"exponent":1e-400,"note":null}'
REASONS = {
    1: "not a JSON object",
    2: "operation and images do not fit",
    3: "operation and images do not fit",
    4: "operation and images do not fit",
    5: "schema or table missing",
    6: "schema or table missing",
    7: "not a JSON object",
    8: "not a JSON object",
    9: "operation and images do not fit",
    13: "schema or table missing",
    14: "not a JSON object",
}


def payloads(spark, folder):
    k = F.col("o_orderkey")
    key = k.cast("string")
    image = F.concat(F.lit('{"o_orderkey":'), key, F.lit(',"amount":12345678901234567890.00100,"exponent":1e-400,"note":null}'))
    schema = F.concat(F.lit("sch"), (F.col("o_custkey") % 30).cast("string"))

    def body(op: str, before, after, schema_token=None, table='"orders"'):
        head = F.concat(F.lit('{"schema":"'), schema, F.lit('"')) if schema_token is None else F.lit('{"schema":' + schema_token)
        return F.concat(
            head, F.lit(f',"table":{table},"op":"{op}"'),
            *([F.lit(',"before":'), before] if before is not None else []),
            *([F.lit(',"after":'), after] if after is not None else []),
            F.lit("}"),
        )

    null = F.lit("null")
    good = body("INSERT", null, image)
    cases = {
        1: F.concat(good, F.lit("x")),
        2: body("DELETE", image, image),
        3: body("UPDATE", null, image),
        4: body("TRUNCATE", None, None),
        5: body("INSERT", null, image, schema_token='""'),
        6: F.concat(F.lit('{"table":"orders","op":"INSERT","after":'), image, F.lit("}")),
        7: F.lit("[]"),
        8: F.substr(good, F.lit(1), F.length(good) - 1),
        9: body("insert", null, image),
        10: body("UPDATE", image, image),
        11: body("DELETE", image, None),
        12: body("INSERT", None, image),
        13: body("INSERT", null, image, table="5"),
        14: F.concat(good, F.lit(" {}")),
    }
    text = F.lit(None).cast("string")
    chain = None
    for n, expr in cases.items():
        chain = F.when(k % 16 == n, expr) if chain is None else chain.when(k % 16 == n, expr)
    return dealt(fx.table(spark, folder, "orders"), "o_orderkey").select((k + 1).alias("ev_id"), chain.otherwise(good).alias("ev_data"), text.alias("_")).drop("_")


REASON_SQL = "CASE o_orderkey % 16 " + " ".join(f"WHEN {n} THEN '{r}'" for n, r in REASONS.items()) + " END"
IMAGE_SQL = """'{"amount":12345678901234567890.00100,"exponent":1e-400,"note":null,"o_orderkey":' || o_orderkey || '}'"""

fx.CTE["decoded"] = (
    [],
    f"""SELECT *, CASE WHEN m IN (2, 3, 10, 11) AND m <> 3 THEN {IMAGE_SQL} END AS before,
    CASE WHEN m NOT IN (1, 4, 7, 8, 11, 14) THEN {IMAGE_SQL} END AS after
    FROM (SELECT o_orderkey, o_orderkey + 1 AS ev_id, CAST(o_orderkey % 16 AS INTEGER) AS m, {REASON_SQL} AS reason,
      'sch' || (o_custkey % 30) AS schema_name, 'orders' AS table_name,
      CASE o_orderkey % 16 WHEN 2 THEN 'DELETE' WHEN 11 THEN 'DELETE' WHEN 3 THEN 'UPDATE' WHEN 10 THEN 'UPDATE' ELSE 'INSERT' END AS op FROM orders)""",
)


def decoded(spark, folder):
    return envelope.decode_change(payloads(spark, folder))


@query(
    "decode_change",
    """SELECT ev_id, reason, CASE WHEN reason IS NULL THEN schema_name END AS schema_name, CASE WHEN reason IS NULL THEN op END AS op,
    CASE WHEN reason IS NULL THEN before END AS before, CASE WHEN reason IS NULL THEN after END AS after FROM decoded""",
    uses="decoded",
)
def decode_change_q(spark, folder):
    rows = decoded(spark, folder)
    good = F.col("reason").isNull()
    shown = ["schema_name", "op", "before", "after"]
    return rows.select("ev_id", "reason", *[F.when(good, F.col(c)).alias(c) for c in shown])


@query(
    "poison_batches",
    """SELECT b, count(*) AS n, count(reason) AS bad, min(ev_id) FILTER (WHERE reason IS NOT NULL) AS first_bad_id,
    arg_min(reason, ev_id) FILTER (WHERE reason IS NOT NULL) AS reason FROM (SELECT *, ev_id // 6 AS b FROM decoded) GROUP BY 1""",
    uses="decoded",
)
def poison_batches_q(spark, folder):
    rows = decoded(spark, folder).withColumn("b", F.expr("ev_id div 6"))
    return envelope.poison_batches(rows, ["b"])


#: Every character that the envelope escapes, in the order in which the text may be rewritten.
_ESCAPED = "d"
for _code, _form in ((92, "\\\\"), (34, '\\"'), *((c, f"\\u{c:04x}") for c in (11, 26, 31, 38, 60, 62, 8232, 8233))):
    _ESCAPED = f"replace({_ESCAPED}, chr({_code}), '{_form}')"


@query(
    "legacy_envelope",
    f"""WITH odd AS (SELECT ev_id, ev_data || CASE ev_id % 4 WHEN 0 THEN '' WHEN 1 THEN '<a&b>' WHEN 2 THEN chr(8232) || chr(8233) || chr(31) || chr(31) || chr(11)
      ELSE chr(92) || 'u001F' || chr(92) || chr(26) END AS d FROM ev)
    SELECT ev_id, '{{"headers":{{"ID":"ep-1:' || ev_id || '","PARTITION_ID":"ep-1"}},"payload":"' || {_ESCAPED} || '"}}' AS value FROM odd""",
    uses="ev",
)
def legacy_envelope_q(spark, folder):
    k = F.col("ev_id") % 4
    odd = F.when(k == 0, "").when(k == 1, "<a&b>").when(k == 2, "\u2028\u2029\x1f\x1f\x0b").otherwise("\\u001F\\\x1a")
    value = envelope.legacy_envelope(F.lit("ep-1"), F.col("ev_id"), F.concat("ev_data", odd))
    return fx.events(spark, folder).select("ev_id", value.alias("value"))


def envelopes(spark, folder):
    """Envelopes, some spoiled, with boundaries in between, by ev_id % 11."""
    k = F.col("ev_id") % 11
    plain = envelope.legacy_envelope(F.lit("ep-1"), F.col("ev_id"), F.col("ev_data"))
    stamp = F.concat(F.date_format("ev_time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    progress = F.concat(F.lit('{"progress":{"version":1,"source_epoch":"ep-1","committed_before":"'), stamp, F.lit('"}}'))
    value = (
        F.when(k == 1, F.regexp_replace(plain, '"payload"', '"extra":1,"payload"'))
        .when(k == 2, F.regexp_replace(plain, "ep-1:", "ep-1:0"))
        .when(k == 3, F.regexp_replace(plain, "ep-1", "ep-2"))
        .when(k == 4, F.concat(plain, F.lit("{}")))
        .when(k == 5, progress)
        .when(k == 6, F.regexp_replace(progress, '"version":1', '"version":2'))
        .when(k == 7, F.regexp_replace(progress, "ep-1", "ep-9"))
        .when(k == 8, F.regexp_replace(plain, ',"payload":.*', "}"))
        .when(k == 9, F.regexp_replace(progress, '\\{"progress"', '{"payload":"x","progress"'))
        .otherwise(plain)
    )
    return fx.events(spark, folder).select(F.col("ev_id").alias("n"), value.alias("value"))


@query(
    "parse_envelope",
    """SELECT ev_id AS n, CASE WHEN k IN (5, 6, 7, 9) THEN 'boundary' ELSE 'data' END AS kind, CASE WHEN k IN (0, 10) THEN ev_id END AS ev_id,
    CASE WHEN k IN (0, 10) THEN ev_data END AS payload, CASE WHEN k = 5 THEN date_trunc('second', ev_time) END AS boundary,
    CASE k WHEN 1 THEN 'malformed envelope' WHEN 2 THEN 'invalid id' WHEN 3 THEN 'other epoch' WHEN 4 THEN 'malformed envelope' WHEN 6 THEN 'unknown version'
      WHEN 7 THEN 'other epoch' WHEN 8 THEN 'missing payload' WHEN 9 THEN 'malformed boundary' END AS envelope_reason FROM (SELECT *, ev_id % 11 AS k FROM ev)""",
    uses="ev",
)
def parse_envelope_q(spark, folder):
    return envelope.parse_envelope(envelopes(spark, folder), F.lit("ep-1")).drop("value")


@query(
    "typed_image",
    """SELECT o_orderkey, unnest(['id', 'amount', 'tiny', 'note', 'empty', 'flag', 'when', 'list', 'nested']) AS field,
    unnest(['number', 'number', 'number', 'null', 'string', 'bool', 'string', 'array', 'object']) AS kind,
    unnest([NULL, NULL, NULL, NULL, NULL, o_orderkey % 2 = 0, NULL, NULL, NULL]) AS bool,
    unnest([NULL, NULL, NULL, NULL, '', NULL, '\u00012 ' || o_orderpriority, NULL, NULL]) AS string,
    unnest([o_orderkey || '', '1234567890123456789' || o_orderkey || '.00100', '1e-400', NULL, NULL, NULL, NULL, NULL, NULL]) AS number_text,
    unnest([NULL, NULL, NULL, NULL, NULL, NULL, NULL, '[null,{},[],0.10]', '{"a":-1.50E+3,"b":"\\u0001x"}']) AS json FROM orders"""
    .replace("\u0001", "' || chr(1) || '"),
)
def typed_image_q(spark, folder):
    k = F.col("o_orderkey").cast("string")
    image = F.concat(
        F.lit('{"id":'), k, F.lit(', "amount":1234567890123456789'), k, F.lit('.00100,"tiny":1e-400,"note":null,"empty":"","flag":'),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"when":"\\u00012 '), F.col("o_orderpriority"), F.lit('","list":[null,{},[],0.10],"nested":{"b":"\\u0001x","a":-1.50E+3}}'),
    )
    images = fx.table(spark, folder, "orders").select("o_orderkey", image.alias("image"))
    return envelope.typed_image(images, "image").drop("image")


@query(
    "cdc_record",
    """SELECT ev_id, 1 AS version, 'ep-1' AS source_epoch, ev_id AS event_id, schema_name AS "schema", table_name AS "table",
    CASE op WHEN 'INSERT' THEN 1 WHEN 'UPDATE' THEN 2 ELSE 3 END AS operation, before, after FROM decoded WHERE reason IS NULL""",
    uses="decoded",
)
def cdc_record_q(spark, folder):
    good = decoded(spark, folder).where(F.col("reason").isNull())
    rec = envelope.cdc_record(good, F.lit("ep-1"))
    return rec.select("ev_id", "record.version", "record.source_epoch", "record.change.*")


@query(
    "frame_records",
    """SELECT event_id, '00' || lpad(hex(event_id + 1), 8, '0') || '00' || hex(encode(props)) AS framed, event_id + 1 AS schema_id, props AS body FROM events""",
)
def frame_records_q(spark, folder):
    ev = fx.table(spark, folder, "events")
    framed = ev.select("event_id", envelope.frame(F.col("event_id") + 1, codecs.utf8(F.col("props"))).alias("f"))
    back = envelope.unframe(F.col("f"))
    return framed.select(
        "event_id", F.hex("f").alias("framed"), back["schema_id"].alias("schema_id"), F.decode(back["body"], "UTF-8").alias("body")
    )


@query(
    "contract_check",
    """WITH reg AS (SELECT 't' || c_custkey || '-value' AS subject, CASE WHEN c_custkey % 4 = 1 THEN 'other' ELSE 'v1' END AS s, CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE c_custkey END AS id
      FROM customer WHERE c_custkey % 6 <> 5)
    SELECT 't' || c_custkey AS topic, min(CASE WHEN r.id BETWEEN 1 AND 2147483647 THEN r.id END) AS schema_id,
    CASE WHEN min(CASE WHEN r.id BETWEEN 1 AND 2147483647 THEN r.id END) IS NULL THEN CASE WHEN count(r.id) > 0 THEN 'id out of range' ELSE 'not registered' END END AS reason
    FROM customer LEFT JOIN reg r ON r.subject = 't' || c_custkey || '-value' AND r.s = 'v1' GROUP BY c_custkey""",
)
def contract_check_q(spark, folder):
    k = F.col("c_custkey")
    topic = F.concat(F.lit("t"), k.cast("string"))
    customers = fx.table(spark, folder, "customer")
    registry = customers.where(k % 6 != 5).select(
        F.concat(topic, F.lit("-value")).alias("subject"),
        F.when(k % 4 == 1, F.lit("other")).otherwise(F.lit("v1")).alias("schema_text"),
        F.when(k % 9 == 0, 0).otherwise(k).alias("id"),
    )
    return envelope.contract_check(customers.select(topic.alias("topic")), registry, "v1")


def routes(spark, folder):
    return fx.table(spark, folder, "nation").select(
        F.concat(F.lit("sch"), F.col("n_nationkey").cast("string")).alias("schema"),
        F.concat(F.lit("cdc."), F.lower("n_name")).alias("topic"),
    )


@query(
    "route_changes",
    """SELECT d.ev_id, n.topic, coalesce(d.reason, CASE WHEN n.topic IS NULL THEN 'schema has no route' END) AS reason
    FROM decoded d LEFT JOIN (SELECT 'sch' || n_nationkey AS s, 'cdc.' || lower(n_name) AS topic FROM nation) n
    ON n.s = CASE WHEN d.m IN (5, 6, 7) OR d.m IN (1, 8, 14) THEN '' ELSE d.schema_name END""",
    uses="decoded",
)
def route_changes_q(spark, folder):
    return envelope.route_changes(decoded(spark, folder), routes(spark, folder)).select("ev_id", "topic", "reason")


@query(
    "check_routes",
    """WITH r AS (SELECT c_nationkey AS source, CASE WHEN c_custkey % 40 = 0 THEN 'Bad-' ELSE 's_' END || c_custkey AS s,
      CASE WHEN c_custkey % 45 = 0 THEN '' WHEN c_custkey % 33 = 0 THEN 'shared' ELSE 't' || c_custkey END AS topic FROM customer),
    t AS (SELECT source, topic, count(*) AS n, count(*) FILTER (WHERE NOT regexp_full_match(s, '[a-z_][a-z0-9_]*')) AS bad FROM r GROUP BY 1, 2)
    SELECT source, sum(n)::BIGINT AS routes, sum(bad)::BIGINT AS bad_names, coalesce(sum(n) FILTER (WHERE topic = ''), 0)::BIGINT AS empty_topics,
    count(*) FILTER (WHERE n > 1 AND topic <> '') AS shared_topics,
    sum(n) <= 16 AND sum(bad) = 0 AND coalesce(sum(n) FILTER (WHERE topic = ''), 0) = 0 AND count(*) FILTER (WHERE n > 1 AND topic <> '') = 0 AS valid FROM t GROUP BY 1""",
)
def check_routes_q(spark, folder):
    k = F.col("c_custkey")
    asked = fx.table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("source"),
        F.concat(F.when(k % 40 == 0, F.lit("Bad-")).otherwise(F.lit("s_")), k.cast("string")).alias("schema"),
        F.when(k % 45 == 0, F.lit("")).when(k % 33 == 0, F.lit("shared")).otherwise(F.concat(F.lit("t"), k.cast("string"))).alias("topic"),
    )
    return envelope.check_routes(asked)


@query(
    "chunk_records",
    """WITH RECURSIVE r AS (SELECT batch_tick, ev_id, 4 + strlen(ev_data) * (1 + ev_id % 7) AS size, row_number() OVER (PARTITION BY batch_tick ORDER BY ev_id) AS n FROM assigned),
    c AS (SELECT batch_tick, ev_id, n, size, CAST(1 AS BIGINT) AS rows_in, CAST(size AS BIGINT) AS bytes_in, CAST(1 AS BIGINT) AS chunk FROM r WHERE n = 1
      UNION ALL SELECT r.batch_tick, r.ev_id, r.n, r.size, CASE WHEN cut THEN 1 ELSE rows_in + 1 END, CASE WHEN cut THEN r.size ELSE bytes_in + r.size END, CASE WHEN cut THEN chunk + 1 ELSE chunk END
      FROM (SELECT c.*, c.rows_in = 20 OR c.bytes_in + r.size > 700 AS cut, r.ev_id AS r_id FROM c JOIN r ON r.batch_tick = c.batch_tick AND r.n = c.n + 1) x
      JOIN r ON r.ev_id = x.r_id)
    SELECT batch_tick, ev_id, size, chunk FROM c""",
    uses="assigned",
)
def chunk_records_q(spark, folder):
    size = F.lit(4) + F.octet_length("ev_data") * (1 + F.col("ev_id") % 7)
    rows = assigned(spark, folder).where(F.col("batch_tick").isNotNull()).select("batch_tick", "ev_id", size.alias("size"))
    return envelope.chunk_records(rows, ["batch_tick"], 20, 700)


@query(
    "key_partition",
    """WITH k AS (SELECT user_id, count(*) AS n, [CAST(ascii(c) AS BIGINT) FOR c IN string_split('user-' || user_id, '')] AS b FROM events GROUP BY user_id),
    w AS (SELECT *, len(b) AS size, len(b) // 4 AS words FROM k),
    x AS (SELECT *, [((b[4 * i + 1] | (b[4 * i + 2] << 8) | (b[4 * i + 3] << 16) | (b[4 * i + 4] << 24)) * 1540483477) & 4294967295 FOR i IN range(words)] AS raw FROM w),
    y AS (SELECT *, list_reduce(list_prepend(xor(2538058380, CAST(size AS BIGINT)), [(xor(r, r >> 24) * 1540483477) & 4294967295 FOR r IN raw]),
      lambda h, r: xor((h * 1540483477) & 4294967295, r)) AS h FROM x),
    z AS (SELECT *, CASE WHEN size % 4 = 0 THEN h ELSE (xor(h, coalesce(b[4 * words + 1], 0) | (coalesce(b[4 * words + 2], 0) << 8) | (coalesce(b[4 * words + 3], 0) << 16))
      * 1540483477) & 4294967295 END AS t FROM y),
    f AS (SELECT *, (xor(t, t >> 13) * 1540483477) & 4294967295 AS u FROM z)
    SELECT user_id, CAST((xor(u, u >> 15) & 2147483647) % 12 AS INTEGER) AS "partition", n FROM f""",
)
def key_partition_q(spark, folder):
    key = codecs.utf8(F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    keyed = fx.table(spark, folder, "events").select("user_id", envelope.partition_for(key, 12).alias("partition"))
    return keyed.groupBy("user_id", "partition").agg(F.count("*").alias("n"))


B64 = "to_base64(encode({x}))"
UUID = "'00000000-0000-0000-0000-' || lpad(lower(hex({x})), 12, '0')"
ID_HEADER = '{{"key": "id", "value": "\' || ' + B64.format(x="{u}") + ' || \'"}}'

fx.CTE["outbox_in"] = (
    [],
    f"""SELECT *, CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS key_text,
    lpad(hex(o_orderkey), 16, '0') || lpad(hex(o_custkey), 16, '0') || hex(encode(o_orderpriority)) AS value_hex,
    CASE WHEN o_orderkey % 17 = 0 THEN '{{"key": "id", "value": "' || {B64.format(x='id')} || '"}}'
      WHEN o_orderkey % 19 = 0 THEN 'wrong' WHEN o_orderkey % 23 = 0 THEN '{{"key": "binary", "value": "AP8="}}, {{"key": "binary", "value": null}}' ELSE '' END AS given
    FROM (SELECT *, {UUID.format(x='o_orderkey')} AS id FROM orders)""",
)
fx.CTE["outbox_ok"] = (
    ["outbox_in"],
    f"""SELECT *, CASE WHEN o_orderkey % 29 = 0 THEN 'unknown stream' WHEN key_text = '' THEN 'invalid key' WHEN given = 'wrong' THEN 'id header differs' END AS reason,
    '[' || CASE WHEN o_orderkey % 17 = 0 THEN given ELSE CASE WHEN given <> '' THEN given || ', ' ELSE '' END || '{{"key": "id", "value": "' || {B64.format(x='id')} || '"}}' END || ']' AS headers_text
    FROM outbox_in""",
)


def outbox_messages(spark, folder):
    k = F.col("o_orderkey")
    ident = codecs.stable_uuid(k)

    def id_header(u):
        return F.concat(F.lit('[{"key":"id","value":"'), codecs.b64(codecs.utf8(u)), F.lit('"}]'))

    headers = (
        F.when(k % 17 == 0, id_header(ident))
        .when(k % 19 == 0, id_header(codecs.stable_uuid(k + 1)))
        .when(k % 23 == 0, F.lit('[{"key":"binary","value":"AP8="},{"key":"binary","value":null}]'))
        .otherwise(F.lit("[]"))
    )
    value = F.concat(codecs.int8_bytes(k), codecs.int8_bytes(F.col("o_custkey")), codecs.utf8(F.col("o_orderpriority")))
    return dealt(fx.table(spark, folder, "orders"), "o_orderkey").select(
        "o_orderkey",
        F.when(k % 29 == 0, F.lit("nobody")).otherwise(F.lit("orders")).alias("stream"),
        ident.alias("id"),
        codecs.utf8(F.when(k % 31 == 0, F.lit("")).otherwise(F.col("o_custkey").cast("string"))).alias("key"),
        value.alias("value"),
        headers.alias("headers"),
    )


def streams(spark, folder):
    """Registered streams: one per nation, and the orders stream."""
    nation = fx.table(spark, folder, "nation")
    named = nation.select(
        F.when(F.col("n_nationkey") == 0, F.lit("orders")).otherwise(F.lower(F.regexp_replace("n_name", "[^A-Za-z0-9]", "-"))).alias("name"),
        codecs.stable_uuid(F.col("n_nationkey")).alias("epoch"),
        F.concat(F.lit("out."), F.col("n_nationkey").cast("string")).alias("topic"),
    )
    return named


def enqueued(spark, folder):
    return outbox.enqueue(outbox_messages(spark, folder), streams(spark, folder))


@query(
    "outbox_enqueue",
    "SELECT o_orderkey, reason, CASE WHEN reason IS NULL THEN headers_text END AS headers FROM outbox_ok",
    uses="outbox_ok",
)
def outbox_enqueue_q(spark, folder):
    return enqueued(spark, folder).select("o_orderkey", "reason", outbox.header_text(F.col("headers_out")).alias("headers"))


def wrapped(spark, folder):
    good = enqueued(spark, folder).where(F.col("reason").isNull())
    return good.select("o_orderkey", outbox.wrap(F.col("id"), F.col("key"), F.col("value"), F.col("headers_out")).alias("body"))


WRAPPER = """'{"id":"' || id || '","key":"' || to_base64(encode(key_text)) || '","value":"' || to_base64(unhex(value_hex)) || '","headers":' || replace(replace(headers_text, ': ', ':'), ', ', ',') || '}'"""


@query("outbox_wrap", f"SELECT o_orderkey, {WRAPPER} AS body FROM outbox_ok WHERE reason IS NULL", uses="outbox_ok")
def outbox_wrap_q(spark, folder):
    return wrapped(spark, folder)


@query(
    "outbox_decode",
    """SELECT o_orderkey, CASE m WHEN 1 THEN 'not a JSON object' WHEN 2 THEN 'invalid id' WHEN 3 THEN 'id header differs' WHEN 4 THEN 'invalid key'
      WHEN 5 THEN 'id header missing or repeated' END AS reason,
    CASE WHEN m NOT IN (1, 2, 3, 4, 5) THEN upper(hex(encode(key_text))) END AS key_hex, CASE WHEN m NOT IN (1, 2, 3, 4, 5) THEN value_hex END AS value_hex,
    CASE WHEN m NOT IN (1, 2, 3, 4, 5) THEN CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 23 = 0 THEN 'binary=00FF,binary=,' ELSE '' END
      || 'id=' || hex(encode(id)) END AS headers FROM (SELECT *, o_orderkey % 12 AS m FROM outbox_ok WHERE reason IS NULL)""",
    uses="outbox_ok",
)
def outbox_decode_q(spark, folder):
    m = F.col("o_orderkey") % 12
    body = (
        F.when(m == 1, F.concat(F.col("body"), F.lit("]")))
        .when(m == 2, F.regexp_replace("body", '^\\{"id":"0', '{"id":"Z'))
        .when(m == 3, F.regexp_replace("body", '^\\{"id":"0', '{"id":"1'))
        .when(m == 4, F.regexp_replace("body", '"key":"[^"]*","value"', '"key":"*","value"'))
        .when(m == 5, F.regexp_replace("body", '"headers":.*', '"headers":[]}'))
        .when(m == 6, F.regexp_replace("body", '"value":"(.{4})', '"value":"$1\\\\n'))
        .otherwise(F.col("body"))
    )
    rows = outbox.decode(wrapped(spark, folder).withColumn("body", body), "body")
    listed = F.array_join(F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), F.coalesce(F.hex(h["value"]), F.lit("")))), ",")
    return rows.select("o_orderkey", "reason", F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"), listed.alias("headers"))


@query(
    "check_streams",
    """WITH req AS (SELECT CASE WHEN c_custkey % 8 = 0 THEN 'Bad ' ELSE 's' END || c_custkey // CASE WHEN c_custkey % 50 IN (2, 3) THEN 2 ELSE 1 END AS name,
      c_custkey // CASE WHEN c_custkey % 70 IN (4, 5) THEN 2 ELSE 1 END + 100000 AS e, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE 't' || c_custkey END AS topic FROM customer),
    old AS (SELECT 's' || s_suppkey * 10 + 1 AS name, s_suppkey * 11 + 100000 AS e FROM supplier)
    SELECT name, '00000000-0000-0000-0000-' || lpad(lower(hex(CAST(e AS BIGINT))), 12, '0') AS epoch, topic,
    CASE WHEN NOT regexp_full_match(name, '[a-z][a-z0-9_-]{0,62}') THEN 'invalid name' WHEN topic = '' THEN 'invalid topic'
      WHEN name IN (SELECT name FROM old) OR count(*) OVER (PARTITION BY name) > 1 THEN 'name taken'
      WHEN e IN (SELECT e FROM old) OR count(*) OVER (PARTITION BY e) > 1 THEN 'epoch taken' END AS reason FROM req"""
    .replace("'s' || s_suppkey * 10 + 1", "'s' || (s_suppkey * 10 + 1)")
    .replace("|| c_custkey // CASE WHEN c_custkey % 50 IN (2, 3) THEN 2 ELSE 1 END", "|| (c_custkey // CASE WHEN c_custkey % 50 IN (2, 3) THEN 2 ELSE 1 END)"),
)
def check_streams_q(spark, folder):
    k = F.col("c_custkey")
    halved = F.expr("c_custkey div (case when c_custkey % 50 in (2, 3) then 2 else 1 end)")
    epoch = F.expr("c_custkey div (case when c_custkey % 70 in (4, 5) then 2 else 1 end)") + 100_000
    asked = fx.table(spark, folder, "customer").select(
        F.concat(F.when(k % 8 == 0, F.lit("Bad ")).otherwise(F.lit("s")), halved.cast("string")).alias("name"),
        codecs.stable_uuid(epoch).alias("epoch"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("t"), k.cast("string"))).alias("topic"),
    )
    s = F.col("s_suppkey")
    existing = fx.table(spark, folder, "supplier").select(
        F.concat(F.lit("s"), (s * 10 + 1).cast("string")).alias("name"), codecs.stable_uuid(s * 11 + 100_000).alias("epoch")
    )
    return outbox.check_streams(asked, existing)


@query(
    "key_order_violations",
    """WITH k AS (SELECT a.queue, a.ev_id % 40 AS key, a.batch_tick, min(a.ev_id) AS lowest_id, max(a.ev_id) AS top FROM assigned a GROUP BY 1, 2, 3),
    m AS (SELECT *, max(top) OVER (PARTITION BY queue, key ORDER BY batch_tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS passed_id FROM k)
    SELECT queue, key, batch_tick, lowest_id, passed_id FROM m WHERE passed_id > lowest_id""",
    uses="assigned",
)
def key_order_violations_q(spark, folder):
    keyed = assigned(spark, folder).withColumn("key", F.col("ev_id") % 40)
    return outbox.key_order_violations(keyed, ["queue", "key"])


@query(
    "route_mismatch",
    """SELECT 's' || c_custkey AS name, 't' || c_custkey // 2 AS topic, 't' || (c_custkey // 2 + CASE WHEN c_custkey % 9 = 0 THEN 1 ELSE 0 END) AS registered_topic
    FROM customer WHERE c_custkey % 9 = 0 AND c_custkey % 6 <> 0
    UNION ALL SELECT 's' || c_custkey, 't' || c_custkey // 2, NULL FROM customer WHERE c_custkey % 6 = 0""".replace("'t' || c_custkey // 2", "'t' || (c_custkey // 2)"),
)
def route_mismatch_q(spark, folder):
    k = F.col("c_custkey")
    customers = fx.table(spark, folder, "customer")
    name = F.concat(F.lit("s"), k.cast("string")).alias("name")
    half = F.expr("c_custkey div 2")
    configured = customers.select(name, F.concat(F.lit("t"), half.cast("string")).alias("topic"))
    moved = half + F.when(k % 9 == 0, 1).otherwise(0)
    registered = customers.where(k % 6 != 0).select(name, F.concat(F.lit("t"), moved.cast("string")).alias("topic"))
    return outbox.route_mismatch(configured, registered)


@query(
    "replay_facts",
    """SELECT o_orderkey, id, upper(hex(encode(key_text))) AS key_hex, value_hex, headers_text AS headers FROM outbox_ok WHERE reason IS NULL AND o_orderkey % 6 = 1""",
    uses="outbox_ok",
)
def replay_facts_q(spark, folder):
    # Only messages that were accepted once are retained as facts.
    facts = enqueued(spark, folder).where(F.col("reason").isNull()).drop("headers_out", "reason")
    chosen = fx.table(spark, folder, "orders").where(F.col("o_orderkey") % 6 == 1).select(codecs.stable_uuid(F.col("o_orderkey")).alias("id"))
    again = outbox.replay_facts(facts, chosen, streams(spark, folder))
    return again.select(
        "o_orderkey", "id", F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"), outbox.header_text(F.col("headers_out")).alias("headers")
    )
