"""Scalar functions over whole texts and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcdc.functions import codecs, text, timeops
from sparkcdc.functions.text import KEYWORDS
from sparkcdc.plans import fixtures as fx
from sparkcdc.plans.capture_queries import ENCODE, LITERAL
from sparkcdc.plans.registry import query


@query("urlencode", f"SELECT doc_id, md5({ENCODE.format(x='text')}) AS digest, CAST(length({ENCODE.format(x='text')}) AS INTEGER) AS chars FROM documents")
def urlencode_q(spark, folder):
    encoded = fx.table(spark, folder, "documents").select("doc_id", text.urlencode(F.col("text")).alias("e"))
    return encoded.select("doc_id", F.md5("e").alias("digest"), F.length("e").alias("chars"))


IDENT = (
    "CASE WHEN regexp_full_match({x}, '[a-z_][a-z0-9_]*') AND {x} NOT IN (" + ",".join(f"'{k}'" for k in KEYWORDS)
    + ") THEN {x} ELSE '\"' || replace({x}, '\"', '\"\"') || '\"' END"
)


@query(
    "sql_quote",
    f"""SELECT doc_id, md5({LITERAL.format(x='text')}) AS literal, coalesce({LITERAL.format(x="nullif(lang, 'en')")}, 'NULL') AS nullable,
    {IDENT.format(x="string_split(text, ' ')[1]")} AS ident FROM documents""",
)
def sql_quote_q(spark, folder):
    docs = fx.table(spark, folder, "documents")
    word = F.split("text", " ")[0]
    return docs.select(
        "doc_id",
        F.md5(text.quote_literal(F.col("text"))).alias("literal"),
        text.quote_nullable(F.nullif("lang", F.lit("en"))).alias("nullable"),
        text.quote_ident(word).alias("ident"),
    )


FQ = "CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN 'app.' || lower(c_mktsegment) ELSE lower(c_mktsegment) || '.Order.\"x\"' END"


@query(
    "quote_fqname",
    f"""SELECT c_custkey, {IDENT.format(x='s')} || '.' || {IDENT.format(x='t')} AS quoted FROM (SELECT c_custkey,
      CASE WHEN contains(n, '.') THEN substr(n, 1, instr(n, '.') - 1) ELSE 'public' END AS s,
      CASE WHEN contains(n, '.') THEN substr(n, instr(n, '.') + 1) ELSE n END AS t FROM (SELECT c_custkey, {FQ} AS n FROM customer))""",
)
def quote_fqname_q(spark, folder):
    k = F.col("c_custkey") % 3
    low = F.lower("c_mktsegment")
    name = F.when(k == 0, F.col("c_name")).when(k == 1, F.concat(F.lit("app."), low)).otherwise(F.concat(low, F.lit('.Order."x"')))
    return fx.table(spark, folder, "customer").select("c_custkey", text.quote_fqname(name).alias("quoted"))


@query(
    "codecs",
    """SELECT o_orderkey, lpad(lower(hex(CAST(o_orderkey AS BIGINT))), 16, '0') AS be8, to_base64(encode(o_orderpriority)) AS b64, hex(encode(o_orderpriority)) AS hexed,
    o_orderkey AS back, o_orderpriority AS text_back FROM orders""",
)
def codecs_q(spark, folder):
    raw = codecs.utf8(F.col("o_orderpriority"))
    be8 = codecs.int8_bytes(F.col("o_orderkey"))
    return fx.table(spark, folder, "orders").select(
        "o_orderkey",
        F.lower(F.hex(be8)).alias("be8"),
        codecs.b64(raw).alias("b64"),
        F.hex(raw).alias("hexed"),
        codecs.bytes_int8(be8).alias("back"),
        F.decode(codecs.unb64(codecs.b64(raw)), "UTF-8").alias("text_back"),
    )


@query("stable_uuid", "SELECT o_orderkey, '00000000-0000-0000-0000-' || lpad(lower(hex(CAST(o_orderkey AS BIGINT))), 12, '0') AS id FROM orders")
def stable_uuid_q(spark, folder):
    return fx.table(spark, folder, "orders").select("o_orderkey", codecs.stable_uuid(F.col("o_orderkey")).alias("id"))


@query("sha256", "SELECT doc_id, sha256(text) AS digest FROM documents")
def sha256_q(spark, folder):
    return fx.table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query(
    "name_patterns",
    """SELECT c_custkey, regexp_full_match(s, '[a-z][a-z0-9_-]{0,62}') AS stream_ok, regexp_full_match(replace(s, '-', '_'), '[a-z_][a-z0-9_]*') AS schema_ok,
    regexp_full_match(u, '[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}') AS id_ok
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE lower(c_mktsegment) || '-' || c_custkey END AS s,
      '00000000-0000-0000-0000-' || lpad(CASE WHEN c_custkey % 2 = 0 THEN lower(hex(c_custkey)) ELSE hex(c_custkey) END, CASE WHEN c_custkey % 5 = 0 THEN 11 ELSE 12 END, '0') AS u FROM customer)""",
)
def name_patterns_q(spark, folder):
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, F.col("c_name")).otherwise(F.concat(F.lower("c_mktsegment"), F.lit("-"), k.cast("string")))
    digits = F.when(k % 2 == 0, F.lower(F.hex(k))).otherwise(F.hex(k))
    uuid = F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(digits, F.when(k % 5 == 0, 11).otherwise(12), F.lit("0")))
    return fx.table(spark, folder, "customer").select(
        "c_custkey",
        name.rlike(codecs.STREAM_NAME).alias("stream_ok"),
        F.replace(name, F.lit("-"), F.lit("_")).rlike(codecs.SCHEMA_NAME).alias("schema_ok"),
        uuid.rlike(codecs.DELIVERY_ID).alias("id_ok"),
    )


@query(
    "json_ops",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'OBJECT' AS kind, 'k' AS keys,
    '{"type":"' || event_type || '","props":' || replace(props, ' ', '') || '}' AS built FROM events""",
)
def json_ops_q(spark, folder):
    ev = fx.table(spark, folder, "events")
    kind = F.regexp_extract(F.schema_of_variant(F.try_parse_json("props")), "^[A-Z]+", 0)
    parsed = F.from_json("props", "k bigint")
    return ev.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        kind.alias("kind"),
        F.array_join(F.json_object_keys("props"), ",").alias("keys"),
        F.to_json(F.struct(F.col("event_type").alias("type"), parsed.alias("props"))).alias("built"),
    )


@query(
    "time_ops",
    """SELECT event_id, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS since_us, epoch_us(ts) // 1000000 AS epoch_s,
    epoch_us(ts + INTERVAL 90 SECOND) AS later_us FROM events""",
)
def time_ops_q(spark, folder):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return fx.table(spark, folder, "events").select(
        "event_id",
        timeops.micros_between(F.col("ts"), start).alias("since_us"),
        F.unix_seconds("ts").alias("epoch_s"),
        timeops.micros(F.col("ts") + F.make_dt_interval(secs=F.lit(90))).alias("later_us"),
    )


@query(
    "array_ops",
    """WITH p AS (SELECT tick_id, xip, lag(xip) OVER (ORDER BY tick_id) AS before FROM ticks)
    SELECT tick_id, pos, x FROM (SELECT tick_id, unnest(d) AS x, unnest(range(len(d))) AS pos FROM
      (SELECT tick_id, list_sort(list_filter(before, lambda v: NOT list_contains(xip, v))) AS d FROM p WHERE before IS NOT NULL))""",
    uses="ticks",
)
def array_ops_q(spark, folder):
    from sparkcdc.operators.batches import tick_pairs

    ended = F.sort_array(F.array_except("last_xip", "xip"))
    rows = tick_pairs(fx.ticks(spark, folder)).select("tick_id", F.posexplode(ended).alias("pos", "x"))
    return rows.select("tick_id", F.col("pos").cast("bigint").alias("pos"), "x")
