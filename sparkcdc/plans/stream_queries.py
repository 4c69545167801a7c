"""Streaming delivery: each query runs a stream over the events table to its end and reads the sink."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from sparkcdc.functions import codecs
from sparkcdc.operators import outbox
from sparkcdc.operators.ordered import dense_positions
from sparkcdc.plans import batch_queries
from sparkcdc.plans import fixtures as fx
from sparkcdc.plans.registry import query
from sparkcdc.session import ensure_checkpoint_dir, stored
from sparkcdc.streaming import apply, delivery, relay, ticker

EPOCH = "ep-1"


def scratch(spark, name: str) -> str:
    """A fresh folder in the shared checkpoint area."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def change_stream(spark, folder, only=None):
    """Captured inserts of the events table as a file stream."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    if only is not None:
        rows = rows.where(only)
    body = F.concat(
        F.lit('{"schema":"public","table":"'), F.col("event_type"), F.lit('","op":"INSERT","before":null,"after":'), F.col("props"), F.lit("}")
    )
    return rows.select((F.col("event_id") + 1).alias("ev_id"), body.alias("ev_data"))


ENVELOPE = """'{"headers":{"ID":"ep-1:' || (event_id + 1) || '","PARTITION_ID":"ep-1"},"payload":"' ||
    replace('{"schema":"public","table":"' || event_type || '","op":"INSERT","before":null,"after":' || props || '}', '"', '\\"') || '"}'"""
SINK_SQL = f"SELECT event_id + 1 AS ev_id, 'cdc.all' AS topic, 'ep-1' AS key, {ENVELOPE} AS value FROM events"


def shown(rows):
    return rows.select("ev_id", "topic", F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"))


def run(spark, folder, publish, place, only=None):
    stream = relay.relay_stream(change_stream(spark, folder, only), relay.cdc_encoder(EPOCH, None, "cdc.all"), publish, f"{place}/checkpoint")
    stream.awaitTermination()


@query("relay_cdc", SINK_SQL)
def relay_cdc_q(spark, folder):
    place = scratch(spark, "relay")
    run(spark, folder, relay.managed_sink(f"{place}/log"), place)
    return shown(spark.read.schema(relay.RECORD_DDL).parquet(f"{place}/log"))


@query("relay_fenced", SINK_SQL)
def relay_fenced_q(spark, folder):
    place = scratch(spark, "fenced")
    run(spark, folder, relay.fenced_sink(f"{place}/log"), place)
    return shown(relay.read_fenced(spark, f"{place}/log"))


@query("relay_fenced_replay", SINK_SQL)
def relay_fenced_replay_q(spark, folder):
    """A batch published again (its acknowledgement was lost) leaves one copy; an unmarked one is unseen."""
    place = scratch(spark, "replayed")
    publish = relay.fenced_sink(f"{place}/log")

    def twice(records, batch_id):
        # Published three times, encoded once.
        records = records.persist(StorageLevel.DISK_ONLY)
        try:
            publish(records, batch_id)
            publish(records, batch_id)
            records.write.mode("overwrite").parquet(f"{place}/log/batches/batch_id={batch_id + 1000}")
        finally:
            records.unpersist()

    run(spark, folder, twice, place)
    return shown(relay.read_fenced(spark, f"{place}/log"))


@query("relay_managed", SINK_SQL)
def relay_managed_q(spark, folder):
    """The same source relayed twice appears twice; an idempotent reader sees each event once."""
    place = scratch(spark, "managed")
    for attempt in ("first", "again"):
        run(spark, folder, relay.managed_sink(f"{place}/log"), f"{place}/{attempt}")
    return shown(relay.applied(spark.read.schema(relay.RECORD_DDL + ", batch_id bigint").parquet(f"{place}/log"), "batch_id"))


@query(
    "multi_stream",
    """SELECT topic, count(*) AS n, min(event_id) + 1 AS first_id, max(event_id) + 1 AS last_id FROM (SELECT 'cdc.q' || (event_id % 3) AS topic, event_id FROM events) GROUP BY 1""",
)
def multi_stream_q(spark, folder):
    place = scratch(spark, "multi")

    def starter(n):
        def start():
            source = change_stream(spark, folder, F.col("event_id") % 3 == n)
            encode = relay.cdc_encoder(EPOCH, None, f"cdc.q{n}")
            return relay.relay_stream(source, encode, relay.fenced_sink(f"{place}/{n}/log"), f"{place}/{n}/checkpoint")

        return start

    states = relay.run_streams({f"s{n}": starter(n) for n in range(3)})
    if set(states.values()) != {"done"}:
        raise RuntimeError(f"streams ended as {states}")
    logs = [relay.read_fenced(spark, f"{place}/{n}/log") for n in range(3)]
    both = logs[0].unionByName(logs[1]).unionByName(logs[2])
    return both.groupBy("topic").agg(F.count("*").alias("n"), F.min("ev_id").alias("first_id"), F.max("ev_id").alias("last_id"))


@query(
    "inbox_stream",
    """SELECT '00000000-0000-0000-0000-' || lpad(lower(hex(event_id // 4)), 12, '0') AS id, min(event_id) AS "offset" FROM events GROUP BY event_id // 4""",
)
def inbox_stream_q(spark, folder):
    """Every delivery id arrives up to four times and is applied once."""
    place = scratch(spark, "inbox")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    log = rows.select(
        codecs.stable_uuid(F.expr("event_id div 4")).alias("id"), F.col("event_id").alias("offset"),
        codecs.utf8(F.lit("k")).alias("key"), codecs.utf8(F.expr("cast(event_id div 4 as string)")).alias("value"),
    )
    apply.inbox_stream(log, f"{place}/effects", f"{place}/checkpoint").awaitTermination()
    return spark.read.schema("id string, offset bigint").parquet(f"{place}/effects").select("id", "offset")


@query("capture_stream", SINK_SQL.replace("'cdc.all' AS topic, 'ep-1' AS key, ", "").replace(ENVELOPE, """'{"schema":"public","table":"events","op":"INSERT","before":null,"after":{"event_id":' || event_id || ',"props":"' || replace(props, '"', '\\"') || '"}}'"""))
def capture_stream_q(spark, folder):
    """Capture on a live feed of written rows."""
    from sparkcdc.operators.capture import capture_feed

    place = scratch(spark, "capture")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    new = F.struct("event_id", "props")
    feed = rows.select((F.col("event_id") + 1).alias("ev_id"), F.lit("INSERT").alias("op"), new.alias("old"), new.alias("new"))
    captured = capture_feed(feed, "public", "events").select("ev_id", F.col("body").alias("value"))
    out = captured.writeStream.format("parquet").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True)
    out.start(f"{place}/log").awaitTermination()
    return spark.read.schema("ev_id bigint, value string").parquet(f"{place}/log")


def tick_files(spark, folder, place, parts=3):
    """The tick log as a table, from the subscription on, and the same ticks as files that arrive one after the other."""
    start = spark.sql(f"SELECT 0L AS tick_id, timestamp_micros(1704067200000000L) AS tick_time, {fx.TXID_BASE}L AS xmin, {fx.TXID_BASE}L AS xmax, cast(array() AS array<bigint>) AS xip, 0L AS event_seq")
    fx.ticks(spark, folder).select(*[F.col(c).cast(start.schema[c].dataType).alias(c) for c in start.columns]).unionByName(start).write.parquet(f"{place}/ticks")
    log = spark.read.schema(start.schema).parquet(f"{place}/ticks")
    top = log.agg(F.max("tick_id").alias("t")).first()["t"]
    for k in range(parts):
        own = log.where(F.expr(f"tick_id * {parts} div {top + 1} = {k}"))
        own.coalesce(1).write.mode("append").parquet(f"{place}/arriving")
    fresh = spark.readStream.schema(start.schema).option("maxFilesPerTrigger", "1").parquet(f"{place}/arriving")
    return log, fresh


def delivered(spark, folder, name, events, encode, topics, parts=2, fenced=True, **settings):
    """Every closed batch of the tick log delivered over ``parts`` micro-batches, and the log a reader sees."""
    place = scratch(spark, name)
    ticks, fresh = tick_files(spark, folder, place, parts)
    # An event log is a table: what is read of it per batch is pushed down to its files.
    events.write.parquet(f"{place}/events")
    events = spark.read.schema(events.schema).parquet(f"{place}/events")
    log = delivery.Log(spark, f"{place}/log", fenced)
    delivery.batch_stream(fresh, events, ticks, encode, log, topics, EPOCH, f"{place}/checkpoint", **settings).awaitTermination()
    return log.read()


def outbox_events(spark, folder):
    """Committed events whose payload is an outbox wrapper; every 23rd has a header without value before its id."""
    k = F.col("ev_id") - 1
    ident = codecs.stable_uuid(k)
    own = F.struct(F.lit("id").alias("key"), codecs.b64(codecs.utf8(ident)).alias("value"))
    empty = F.struct(F.lit("empty").alias("key"), F.lit(None).cast("string").alias("value"))
    headers = F.when(k % 23 == 0, F.array(empty, own)).otherwise(F.array(own))
    value = F.concat(codecs.int8_bytes(k), codecs.utf8(F.col("ev_type")))
    body = outbox.wrap(ident, codecs.utf8(F.col("queue")), value, headers)
    return fx.committed_events(spark, folder).select("ev_id", "ev_txid", body.alias("ev_data"))


def change_events(spark, folder):
    """Committed events as captured inserts, in one schema per type; their schemas have routes of their own."""
    body = F.concat(
        F.lit('{"schema":"'), F.col("ev_type"), F.lit('","table":"t","op":"INSERT","before":null,"after":'), F.col("ev_data"), F.lit("}")
    )
    return fx.committed_events(spark, folder).select("ev_id", "ev_txid", body.alias("ev_data"))


def log_shown(rows):
    listed = F.array_join(F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), F.coalesce(F.hex(h["value"]), F.lit("")))), ",")
    return rows.select("topic", "offset", "batch_tick", "chunk", "kind", "ev_id", F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"), listed.alias("headers"))


CHUNK = 40
OUTBOX_LOG = f"""SELECT 'out.all' AS topic, row_number() OVER (ORDER BY batch_tick, ev_id) - 1 AS "offset", batch_tick,
    (row_number() OVER (PARTITION BY batch_tick ORDER BY ev_id) - 1) // {CHUNK} + 1 AS chunk, 'data' AS kind, ev_id, hex(encode(queue)) AS key_hex,
    lpad(hex(ev_id - 1), 16, '0') || hex(encode(ev_type)) AS value_hex,
    CASE WHEN (ev_id - 1) % 23 = 0 THEN 'empty=,' ELSE '' END || 'id=' || hex(encode('00000000-0000-0000-0000-' || lpad(lower(hex(ev_id - 1)), 12, '0'))) AS headers
    FROM assigned WHERE batch_tick IS NOT NULL"""


@query("relay_outbox", OUTBOX_LOG, uses="assigned")
def relay_outbox_q(spark, folder):
    """The outbox in closed batches, at least once: in order, with offsets and chunks."""
    events = outbox_events(spark, folder)
    return log_shown(delivered(spark, folder, "outbox", events, relay.outbox_encoder("out.all"), ["out.all"], fenced=False, batch=CHUNK))


@query("relay_outbox_fenced", OUTBOX_LOG, uses="assigned")
def relay_outbox_fenced_q(spark, folder):
    """The same behind a fence per chunk."""
    events = outbox_events(spark, folder)
    return log_shown(delivered(spark, folder, "outbox-fenced", events, relay.outbox_encoder("out.all"), ["out.all"], batch=CHUNK))


ROUTED_CTE = """routes AS (SELECT * FROM (VALUES ('error', 'cdc.errors'), ('never', 'cdc.idle')) AS t("schema", topic)
      UNION ALL SELECT DISTINCT ev_type, 'cdc.' || ev_type FROM ev WHERE ev_type <> 'error'),
    data AS (SELECT topic, batch_tick, ev_id, 0 AS last, (row_number() OVER (PARTITION BY batch_tick ORDER BY ev_id) - 1) // 40 + 1 AS chunk, 'data' AS kind, '65702D31' AS key_hex,
      hex(encode('{"headers":{"ID":"ep-1:' || ev_id || '","PARTITION_ID":"ep-1"},"payload":"' ||
        replace('{"schema":"' || ev_type || '","table":"t","op":"INSERT","before":null,"after":' || ev_data || '}', '"', '\\"') || '"}')) AS value_hex
      FROM assigned JOIN routes ON "schema" = ev_type WHERE batch_tick IS NOT NULL)"""
ROUTED_LOG = f"""WITH {ROUTED_CTE}
    SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY batch_tick, ev_id) - 1 AS "offset", batch_tick, chunk, kind, ev_id, key_hex, value_hex, CAST(NULL AS VARCHAR) AS headers FROM data"""
BOUNDARY_LOG = f"""WITH {ROUTED_CTE},
    ends AS (SELECT t.tick_id, t.tick_time, coalesce(max(chunk), 0) + 1 AS chunk FROM ticks t LEFT JOIN data ON batch_tick = t.tick_id GROUP BY 1, 2),
    marks AS (SELECT topic, tick_id AS batch_tick, CAST(NULL AS BIGINT) AS ev_id, 1 AS last, chunk, 'boundary' AS kind, '65702D31' AS key_hex,
      hex(encode('{{"progress":{{"version":1,"source_epoch":"ep-1","committed_before":"' || strftime(tick_time, '%Y-%m-%dT%H:%M:%S') || 'Z"}}}}')) AS value_hex FROM ends, routes)
    SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY batch_tick, last, ev_id) - 1 AS "offset", batch_tick, chunk, kind, ev_id, key_hex, value_hex, CAST(NULL AS VARCHAR) AS headers
    FROM (SELECT * FROM data UNION ALL SELECT * FROM marks)"""


def routes_of(spark, folder):
    """One topic per schema that occurs, and one that stays idle."""
    kinds = fx.events(spark, folder).select(F.col("ev_type").alias("schema")).distinct()
    named = F.when(F.col("schema") == "error", F.lit("cdc.errors")).otherwise(F.concat(F.lit("cdc."), F.col("schema")))
    idle = spark.sql("SELECT 'never' AS schema, 'cdc.idle' AS topic")
    return stored(kinds.select("schema", named.alias("topic")).unionByName(idle))


def routed_delivery(spark, folder, name, **settings):
    routes = routes_of(spark, folder)
    # Routes are configuration, at most a few per relay.
    topics = [r["topic"] for r in routes.limit(delivery.MAX_TOPICS + 1).collect()]
    return log_shown(delivered(spark, folder, name, change_events(spark, folder), relay.cdc_encoder(EPOCH, routes), topics, batch=CHUNK, **settings))


@query("relay_routed", ROUTED_LOG, uses="assigned ev")
def relay_routed_q(spark, folder):
    """Changes in closed batches, each schema on its route, offsets per route."""
    return routed_delivery(spark, folder, "routed")


@query("relay_boundaries", BOUNDARY_LOG, uses="assigned ev ticks")
def relay_boundaries_q(spark, folder):
    """The same with a boundary on every route after each batch, idle routes and empty batches included."""
    return routed_delivery(spark, folder, "boundaries", every_us=1)


# The ticker told to pause q2 for some days, to force a tick of q1, and to take the ticks of q0 from outside.
PAUSED_FROM, PAUSED_TO, FORCED_AT = 1704499200000000, 1704758400000000, 1704844800000000
POLLED, FOLDED = batch_queries.CLOSED.split(",\n    fold AS", 1)
TICKER_SQL = f"""WITH RECURSIVE {POLLED.replace("polls AS", "every_poll AS", 1)},
    polls AS (SELECT queue, at_us, event_seq, row_number() OVER (PARTITION BY queue ORDER BY at_us) AS n FROM every_poll
      WHERE queue <> 'q0' AND NOT (queue = 'q2' AND at_us >= {PAUSED_FROM} AND at_us < {PAUSED_TO})),
    fold AS{FOLDED % f"(p.queue = 'q1' AND f.at_us < {FORCED_AT} AND p.at_us >= {FORCED_AT}) OR"},
    offers AS (SELECT n // 5 AS k, at_us, n // 5 * 10 - CASE WHEN n // 5 % 7 = 0 THEN 10 ELSE 0 END AS tick_id, event_seq - CASE WHEN n // 5 % 7 = 3 THEN 200 ELSE 0 END AS event_seq
      FROM every_poll WHERE queue = 'q0' AND n % 5 = 0),
    taken AS (SELECT k, at_us, tick_id, event_seq, tick_id AS max_tick, event_seq AS max_seq, CAST(NULL AS VARCHAR) AS reason FROM offers WHERE k = 1
      UNION ALL SELECT k, at_us, tick_id, event_seq, CASE WHEN r IS NULL THEN tick_id ELSE max_tick END, CASE WHEN r IS NULL THEN event_seq ELSE max_seq END, r
      FROM (SELECT o.*, t.max_tick, t.max_seq, CASE WHEN o.tick_id <= t.max_tick THEN 'tick id not rising' WHEN o.event_seq < t.max_seq THEN 'event seq falls' END AS r
        FROM taken t JOIN offers o ON o.k = t.k + 1))
    SELECT queue, tick_id, at_us, event_seq, 'poll' AS kind, CAST(NULL AS VARCHAR) AS reason FROM fold WHERE ticked
    UNION ALL SELECT 'q0', tick_id, at_us, event_seq, 'tick', reason FROM taken
    UNION ALL SELECT * FROM (VALUES ('q2', NULL, {PAUSED_FROM + 1}, NULL, 'force', 'paused'), ('q0', NULL, {FORCED_AT}, NULL, 'force', 'external'),
      ('none', NULL, {FORCED_AT}, NULL, 'force', 'queue not found'), ('q1', 7, {PAUSED_FROM}, 7, 'tick', 'not external'))"""


@query("ticker_stream", TICKER_SQL, uses="ev")
def ticker_stream_q(spark, folder):
    """Polls, settings, forced and external ticks over four micro-batches."""
    place = scratch(spark, "ticker")
    polls, queues = batch_queries.polls_and_queues(spark, folder)
    polls = stored(polls)
    created = queues.distinct().select("queue", F.lit(0).alias("at_us"), F.lit("queue").alias("kind"), "max_count", "max_lag_us", "idle_us", F.lit(False).alias("paused"), (F.col("queue") == "q0").alias("external"))
    n = dense_positions(polls.where("queue = 'q0'"), [], "at_us", "n", 1 << 40)
    k = F.expr("n div 5")
    offers = n.where("n % 5 = 0").select(
        "queue", "at_us", F.lit("tick").alias("kind"), (k * 10 - F.when(k % 7 == 0, 10).otherwise(0)).alias("tick_id"), (F.col("event_seq") - F.when(k % 7 == 3, 200).otherwise(0)).alias("event_seq")
    )
    told = spark.createDataFrame(
        [
            ("q2", PAUSED_FROM, "queue", None, None, True), ("q2", PAUSED_FROM + 1, "force", None, None, None), ("q2", PAUSED_TO, "queue", None, None, False),
            ("q1", FORCED_AT, "force", None, None, None), ("q0", FORCED_AT, "force", None, None, None), ("none", FORCED_AT, "force", None, None, None),
            ("q1", PAUSED_FROM, "tick", 7, 7, None),
        ],
        "queue string, at_us bigint, kind string, tick_id bigint, event_seq bigint, paused boolean",
    )
    calls = polls.select("queue", "at_us", "event_seq", F.lit("poll").alias("kind"))
    for more in (created, offers, told):
        calls = calls.unionByName(more, allowMissingColumns=True)
    schema = spark.createDataFrame([], ticker.CALLS).schema
    calls = stored(calls.select(*[F.col(f.name).cast(f.dataType) for f in schema]))
    span = calls.where("at_us > 0").agg(F.min("at_us").alias("low"), F.max("at_us").alias("high")).first()
    part = F.greatest(F.lit(0), F.expr(f"(at_us - {span['low']}) * 4 div {span['high'] - span['low'] + 1}"))
    for p in range(4):
        calls.where(part == p).coalesce(1).write.mode("append").parquet(f"{place}/calls")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{place}/calls")
    out = ticker.ticker_stream(source).writeStream.format("parquet").option("checkpointLocation", f"{place}/checkpoint").outputMode("append")
    out.trigger(availableNow=True).start(f"{place}/ticks").awaitTermination()
    return spark.read.schema(ticker.ANSWERS).parquet(f"{place}/ticks")
