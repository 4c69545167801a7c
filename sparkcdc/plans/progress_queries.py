"""Boundaries, the guarded consumer, idempotent apply."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcdc.functions import codecs
from sparkcdc.operators import inbox, progress
from sparkcdc.plans import fixtures as fx
from sparkcdc.plans.batch_queries import assigned
from sparkcdc.plans.capture_queries import changes
from sparkcdc.plans.envelope_queries import decoded
from sparkcdc.plans.registry import query
from sparkcdc.session import stored

MINUTE = 60_000_000
START = 1_704_067_200_000_000
SKEW = 5_000_000
MAX_LAG = 90_000_000


def routed(spark, folder):
    """Committed events on two topics per queue, with their batch."""
    topic = F.concat("queue", F.when(F.col("ev_type") == "error", F.lit(".err")).otherwise(F.lit(".main")))
    return assigned(spark, folder).where(F.col("batch_tick").isNotNull()).select(
        "queue", topic.alias("topic"), F.col("batch_tick").alias("tick_id"), "ev_id", "ev_type", "ev_data"
    )


def topic_routes(spark, folder):
    suffixes = F.explode(F.array(F.lit(".main"), F.lit(".err"), F.lit(".idle"))).alias("suffix")
    return fx.events(spark, folder).select("queue").distinct().select("queue", suffixes).select(
        "queue", F.concat("queue", "suffix").alias("topic")
    )


def batch_ends(spark, folder):
    return fx.queue_ticks(spark, folder).select("queue", "tick_id", F.unix_micros("tick_time").alias("end_us"))


def marks(spark, folder, every=MINUTE):
    return progress.boundaries(batch_ends(spark, folder), topic_routes(spark, folder), every, by=["queue"])


fx.CTE["routed"] = (
    ["assigned"],
    "SELECT queue, queue || CASE WHEN ev_type = 'error' THEN '.err' ELSE '.main' END AS topic, batch_tick AS tick_id, ev_id, ev_type, ev_data FROM assigned",
)
fx.CTE["marks"] = (
    ["qticks"],
    "SELECT queue, queue || s AS topic, tick_id, epoch_us(tick_time) AS end_us FROM qticks, (SELECT unnest(['.main', '.err', '.idle']) AS s)",
)
fx.CTE["log"] = (
    ["routed", "marks"],
    """SELECT *, 2 * row_number() OVER (PARTITION BY queue, topic ORDER BY tick_id, kind DESC, ev_id) AS "offset" FROM
    (SELECT queue, topic, tick_id, ev_id, ev_type, 'data' AS kind, NULL::BIGINT AS end_us FROM routed UNION ALL SELECT queue, topic, tick_id, NULL, NULL, 'boundary', end_us FROM marks)""",
)


def log(spark, folder):
    """The merged log, stored: a consumer reads a topic, not the job that fills it."""
    data = stored(routed(spark, folder).drop("ev_data"))
    return stored(progress.merge_log(data, stored(marks(spark, folder)), ["queue", "topic"], spacing=2))


@query("boundaries", "SELECT queue, topic, tick_id, end_us FROM marks", uses="marks")
def boundaries_q(spark, folder):
    return marks(spark, folder)


@query(
    "boundaries_every",
    """WITH RECURSIVE f AS (SELECT queue, tick_id, epoch_us(tick_time) AS end_us, epoch_us(tick_time) AS last_us, true AS due FROM qticks WHERE tick_id = 1
      UNION ALL SELECT t.queue, t.tick_id, epoch_us(t.tick_time), CASE WHEN epoch_us(t.tick_time) - f.last_us >= 210000000 THEN epoch_us(t.tick_time) ELSE f.last_us END,
        epoch_us(t.tick_time) - f.last_us >= 210000000 FROM f JOIN qticks t ON t.queue = f.queue AND t.tick_id = f.tick_id + 1)
    SELECT queue, tick_id, end_us FROM f WHERE due""",
    uses="qticks",
)
def boundaries_every_q(spark, folder):
    return progress.due_batches(batch_ends(spark, folder), 210_000_000, by=["queue"])


@query("merged_log", 'SELECT topic, tick_id, ev_id, kind, "offset" FROM log', uses="log")
def merged_log_q(spark, folder):
    return log(spark, folder).select("topic", "tick_id", "ev_id", "kind", "offset")


# One consumer per topic; the spoiled rows make some of them fail at different causes.
fx.CTE["feed"] = (
    ["log"],
    """SELECT topic AS consumer, "offset" AS seq, CASE WHEN "offset" = 900 AND topic = 'q0.main' THEN 'elsewhere' ELSE 'cdc' END AS topic, 0 AS partition,
    CASE WHEN "offset" = 700 AND topic = 'q1.main' THEN 650 ELSE "offset" END AS "offset", CASE WHEN "offset" = 300 AND topic = 'q2.err' THEN 'ep-2' ELSE 'ep-1' END AS key,
    kind, CASE WHEN kind = 'boundary' THEN CASE WHEN tick_id = 40 AND topic = 'q2.main' THEN 2 ELSE 1 END END AS version,
    CASE WHEN kind = 'boundary' THEN CASE WHEN tick_id = 30 AND topic = 'q1.idle' THEN 0 WHEN tick_id = 35 AND topic = 'q2.idle' THEN end_us + 3600000000 ELSE end_us END END AS boundary_us,
    1704067200000000 + tick_id * 60000000 + CASE WHEN kind = 'data' THEN 1000000 ELSE 2000000 END AS now_us,
    CASE WHEN kind = 'data' THEN 'public' END AS schema_name, CASE WHEN kind = 'data' THEN CASE WHEN ev_type = 'error' AND ev_id % 1501 = 0 THEN 'other' ELSE ev_type END END AS table_name, NULL::VARCHAR AS reason FROM log""",
)
fx.CTE["judged"] = (
    ["feed"],
    """SELECT *, CASE WHEN topic <> 'cdc' THEN 'other topic' WHEN "offset" <= mo THEN 'offset does not rise' WHEN key <> 'ep-1' THEN 'other epoch'
      WHEN kind = 'boundary' THEN CASE WHEN version <> 1 THEN 'unknown version' WHEN boundary_us < mb THEN 'boundary falls' WHEN boundary_us > now_us + 5000000 THEN 'boundary in the future' END
      WHEN table_name = 'other' THEN 'unknown table' END AS problem
    FROM (SELECT *, max("offset") OVER w AS mo, max(boundary_us) OVER w AS mb FROM feed WINDOW w AS (PARTITION BY consumer ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
)
fx.CTE["failures"] = (
    ["judged"],
    "SELECT consumer, min(seq) AS failed_seq, arg_min(problem, seq) AS problem, arg_min(now_us, seq) AS failed_us FROM judged WHERE problem IS NOT NULL GROUP BY 1",
)
fx.CTE["accepted"] = (
    ["judged", "failures"],
    "SELECT j.* FROM judged j LEFT JOIN failures f USING (consumer) WHERE f.failed_seq IS NULL OR j.seq < f.failed_seq",
)


def feed(spark, folder):
    rows = log(spark, folder)
    t, at, tick = F.col("topic"), F.col("offset"), F.col("tick_id")
    boundary = F.col("kind") == "boundary"
    mark = (
        F.when((tick == 30) & (t == "q1.idle"), F.lit(0))
        .when((tick == 35) & (t == "q2.idle"), F.col("end_us") + 3_600_000_000)
        .otherwise(F.col("end_us"))
    )
    table = F.when((F.col("ev_type") == "error") & (F.col("ev_id") % 1501 == 0), F.lit("other")).otherwise(F.col("ev_type"))
    return rows.select(
        t.alias("consumer"),
        at.alias("seq"),
        F.when((at == 900) & (t == "q0.main"), F.lit("elsewhere")).otherwise(F.lit("cdc")).alias("topic"),
        F.lit(0).alias("partition"),
        F.when((at == 700) & (t == "q1.main"), F.lit(650)).otherwise(at).alias("offset"),
        F.when((at == 300) & (t == "q2.err"), F.lit("ep-2")).otherwise(F.lit("ep-1")).alias("key"),
        F.lit(100).alias("value_bytes"),
        "kind",
        F.when(boundary, F.when((tick == 40) & (t == "q2.main"), 2).otherwise(1)).alias("version"),
        F.when(boundary, mark).alias("boundary_us"),
        (F.lit(START) + tick * MINUTE + F.when(boundary, 2_000_000).otherwise(1_000_000)).alias("now_us"),
        F.when(~boundary, F.lit("public")).alias("schema_name"),
        F.when(~boundary, table).alias("table_name"),
        F.lit(None).cast("string").alias("reason"),
    )


def scope(spark, folder):
    return fx.table(spark, folder, "events").select(F.lit("public").alias("schema_name"), F.col("event_type").alias("table_name")).distinct()


class Consumers:
    """The feed of every consumer, what it accepted, where it failed, and its leases."""

    def __init__(self, spark, folder):
        rows = feed(spark, folder)
        accepted, failures = progress.check_log(rows, scope(spark, folder), F.lit("ep-1"), "cdc", SKEW)
        self.accepted, self.failures = stored(accepted), stored(failures)
        at = rows.select("consumer", F.col("seq").alias("failed_seq"), F.col("now_us").alias("failed_us"))
        self.failed_at = self.failures.join(at, ["consumer", "failed_seq"]).select("consumer", "failed_us")

    def spans(self):
        return progress.leases(self.accepted, F.lit(START + 3 * MINUTE), MAX_LAG, SKEW)


@query(
    "check_log",
    "SELECT a.consumer, count(*) AS accepted, count(*) FILTER (WHERE kind = 'data') AS data, f.failed_seq, f.problem FROM accepted a LEFT JOIN failures f USING (consumer) GROUP BY 1, 4, 5",
    uses="accepted failures",
)
def check_log_q(spark, folder):
    state = Consumers(spark, folder)
    counted = state.accepted.groupBy("consumer").agg(F.count("*").alias("accepted"), F.count_if(F.col("kind") == "data").alias("data"))
    return counted.join(state.failures, "consumer", "left")


fx.CTE["spans"] = (
    ["accepted"],
    f"""SELECT consumer, seq, now_us AS from_us, boundary_us + {MAX_LAG - SKEW} AS expiry_us, least(boundary_us + {MAX_LAG - SKEW}, nxt) AS until_us
    FROM (SELECT *, lead(now_us) OVER (PARTITION BY consumer ORDER BY seq) AS nxt FROM accepted WHERE kind = 'boundary') WHERE boundary_us > {START + 3 * MINUTE} + {SKEW}""",
)


@query("leases", "SELECT * FROM spans", uses="spans")
def leases_q(spark, folder):
    return Consumers(spark, folder).spans()


fx.CTE["probes"] = (
    [],
    f"SELECT DISTINCT 'q' || (user_id % 3) || CASE event_id % 4 WHEN 0 THEN '.idle' WHEN 1 THEN '.err' ELSE '.main' END AS consumer, {START} + event_id * 7000000 % 5400000000 AS at_us FROM events",
)


def probes(spark, folder):
    k = F.col("event_id")
    suffix = F.when(k % 4 == 0, F.lit(".idle")).when(k % 4 == 1, F.lit(".err")).otherwise(F.lit(".main"))
    return fx.table(spark, folder, "events").select(
        F.concat(F.lit("q"), (F.col("user_id") % 3).cast("string"), suffix).alias("consumer"), (F.lit(START) + k * 7_000_000 % 5_400_000_000).alias("at_us")
    ).distinct()


READY = """EXISTS (SELECT 1 FROM spans s WHERE s.consumer = p.consumer AND s.from_us <= {t} AND {t} < s.until_us)
    AND NOT EXISTS (SELECT 1 FROM failures f WHERE f.consumer = p.consumer AND {t} >= f.failed_us)"""


@query("ready_at", f"SELECT consumer, at_us, {READY.format(t='p.at_us')} AS ready FROM probes p", uses="probes spans failures")
def ready_at_q(spark, folder):
    state = Consumers(spark, folder)
    return progress.ready_at(probes(spark, folder), state.spans(), state.failed_at, 10 * MINUTE)


@query(
    "cache_fill_valid",
    f"""SELECT consumer, at_us AS begin_us, at_us + 3000000 AS store_us, {READY.format(t='p.at_us')} AND {READY.format(t='(p.at_us + 3000000)')} AND at_us % 11 <> 0
    AND NOT EXISTS (SELECT 1 FROM accepted a WHERE a.consumer = p.consumer AND a.kind = 'data' AND a.now_us > p.at_us AND a.now_us <= p.at_us + 3000000) AS valid FROM probes p""",
    uses="probes spans failures accepted",
)
def cache_fill_valid_q(spark, folder):
    at = F.col("at_us")
    reads = probes(spark, folder).select(
        "consumer",
        F.lit(1).alias("generation"),
        at.alias("begin_us"),
        F.when(at % 11 == 0, 2).otherwise(1).alias("store_generation"),
        (at + 3_000_000).alias("store_us"),
    )
    state = Consumers(spark, folder)
    valid = progress.cache_fill_valid(reads, state.accepted, stored(state.spans()), state.failed_at, 10 * MINUTE)
    return valid.select("consumer", "begin_us", "store_us", "valid")


@query(
    "invalidations",
    """SELECT * FROM (SELECT 'o_orderkey' AS "column", CAST(unnest([b_o_orderkey, a_o_orderkey]) AS VARCHAR) AS value FROM changes
    UNION SELECT 'o_custkey', CAST(unnest([b_o_custkey, a_o_custkey]) AS VARCHAR) FROM changes) WHERE value IS NOT NULL""",
    uses="changes",
)
def invalidations_q(spark, folder):
    return inbox.invalidations(changes(spark, folder), ["o_orderkey", "o_custkey"])


@query(
    "retention_gap",
    """WITH low AS (SELECT topic || '-' || (ev_id % 5) AS consumer, min("offset") AS log_start FROM log WHERE kind = 'data' GROUP BY 1),
    c AS (SELECT topic || '-' || (ev_id % 5) AS consumer, min(ev_id) % 9 AS next_offset FROM log WHERE kind = 'data' GROUP BY 1)
    SELECT consumer, next_offset, log_start FROM low JOIN c USING (consumer) WHERE next_offset < log_start""",
    uses="log",
)
def retention_gap_q(spark, folder):
    rows = log(spark, folder).where(F.col("kind") == "data")
    named = rows.withColumn("consumer", F.concat("topic", F.lit("-"), (F.col("ev_id") % 5).cast("string")))
    committed = named.groupBy("consumer").agg((F.min("ev_id") % 9).alias("next_offset"))
    return progress.retention_gap(committed, named)


@query(
    "managed_boundaries",
    """WITH m AS (SELECT topic, tick_id * 2 AS seq, end_us AS boundary_us FROM marks UNION ALL SELECT topic, tick_id * 2 + 7, end_us - 60000000 FROM marks WHERE tick_id % 3 = 0)
    SELECT topic, seq, boundary_us FROM (SELECT *, max(boundary_us) OVER (PARTITION BY topic ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM m) WHERE best IS NULL OR boundary_us > best""",
    uses="marks",
)
def managed_boundaries_q(spark, folder):
    sent = marks(spark, folder)
    first = sent.select("topic", (F.col("tick_id") * 2).alias("seq"), F.col("end_us").alias("boundary_us"))
    late = sent.where(F.col("tick_id") % 3 == 0).select("topic", (F.col("tick_id") * 2 + 7).alias("seq"), (F.col("end_us") - MINUTE).alias("boundary_us"))
    return progress.managed_boundaries(first.unionByName(late), ["topic"], "seq")


@query(
    "complete_prefix",
    """WITH d AS (SELECT topic, tick_id, kind, CASE WHEN kind = 'boundary' AND tick_id % 10 = 0 THEN "offset" - 5 ELSE "offset" END AS o FROM log WHERE NOT (kind = 'data' AND ev_id % 501 = 0)),
    b AS (SELECT topic, tick_id, min(o) FILTER (WHERE kind = 'boundary') AS boundary_offset, max(o) FILTER (WHERE kind = 'data') AS last_data, count(*) FILTER (WHERE kind = 'data') AS delivered FROM d GROUP BY 1, 2),
    e AS (SELECT topic, tick_id, count(*) AS n FROM routed GROUP BY 1, 2)
    SELECT b.topic, b.tick_id, boundary_offset, delivered, delivered = coalesce(n, 0) AND (last_data IS NULL OR last_data < boundary_offset) AS complete FROM b LEFT JOIN e USING (topic, tick_id)""",
    uses="log routed",
)
def complete_prefix_q(spark, folder):
    rows = log(spark, folder)
    early = (F.col("kind") == "boundary") & (F.col("tick_id") % 10 == 0)
    seen = rows.where(~F.coalesce((F.col("kind") == "data") & (F.col("ev_id") % 501 == 0), F.lit(False))).withColumn(
        "offset", F.when(early, F.col("offset") - 5).otherwise(F.col("offset"))
    )
    expected = routed(spark, folder).groupBy("topic", "tick_id").agg(F.count("*").alias("n"))
    return progress.complete_prefix(seen, expected)


PREFIX = "p AS (SELECT *, ev_id // 40 AS b FROM decoded), bad AS (SELECT b, min(ev_id) AS first_bad_id FROM p WHERE reason IS NOT NULL AND m IN (7, 8) AND o_orderkey % 3 = 0 GROUP BY 1)"


def poisoned(spark, folder):
    rows = decoded(spark, folder)
    k = F.col("ev_id") - 1
    real = (k % 16).isin(7, 8) & (k % 3 == 0)
    return rows.select(F.expr("ev_id div 40").alias("b"), "ev_id", F.when(real, F.col("reason")).alias("reason"))


@query(
    "prefix_before_poison",
    f"WITH {PREFIX} SELECT p.b, count(*) AS out_rows, max(ev_id) AS last_out FROM p LEFT JOIN bad USING (b) WHERE first_bad_id IS NULL OR ev_id < first_bad_id GROUP BY 1",
    uses="decoded",
)
def prefix_before_poison_q(spark, folder):
    out, _ = progress.prefix_before_poison(poisoned(spark, folder), ["b"])
    return out.groupBy("b").agg(F.count("*").alias("out_rows"), F.max("ev_id").alias("last_out"))


@query("pending_batches", f"WITH {PREFIX} SELECT b, first_bad_id FROM bad", uses="decoded")
def pending_batches_q(spark, folder):
    return progress.prefix_before_poison(poisoned(spark, folder), ["b"])[1]


DIGEST = "sha256('[\"' || to_base64(encode({k})) || '\",\"' || to_base64(encode({v})) || '\"]')"
fx.CTE["deliveries"] = (
    ["ev"],
    f"""SELECT *, {DIGEST.format(k='k', v='v')} AS digest FROM (SELECT '00000000-0000-0000-0000-' || lpad(lower(hex(ev_id)), 12, '0') AS id, ev_id AS "offset", queue AS k, ev_data AS v FROM ev
    UNION ALL SELECT '00000000-0000-0000-0000-' || lpad(lower(hex(ev_id)), 12, '0'), ev_id + 10000000, queue, CASE WHEN ev_id % 500 = 0 THEN ev_data || '!' ELSE ev_data END FROM ev WHERE ev_id % 50 = 0)""",
)
fx.CTE["receipts"] = (
    ["ev"],
    f"""SELECT '00000000-0000-0000-0000-' || lpad(lower(hex(ev_id)), 12, '0') AS id, {DIGEST.format(k='queue', v="CASE WHEN ev_id % 700 = 0 THEN 'old' ELSE ev_data END")} AS digest FROM ev WHERE ev_id % 7 = 0""",
)


def deliveries(spark, folder):
    ev = fx.events(spark, folder)
    value = F.when(F.col("ev_id") % 500 == 0, F.concat("ev_data", F.lit("!"))).otherwise(F.col("ev_data"))
    ident = codecs.stable_uuid(F.col("ev_id")).alias("id")
    first = ev.select(ident, F.col("ev_id").alias("offset"), codecs.utf8(F.col("queue")).alias("key"), codecs.utf8(F.col("ev_data")).alias("value"))
    again = ev.where(F.col("ev_id") % 50 == 0).select(
        ident, (F.col("ev_id") + 10_000_000).alias("offset"), codecs.utf8(F.col("queue")).alias("key"), codecs.utf8(value).alias("value")
    )
    return inbox.with_digest(first.unionByName(again))


def receipts(spark, folder):
    old = F.when(F.col("ev_id") % 700 == 0, F.lit("old")).otherwise(F.col("ev_data"))
    return fx.events(spark, folder).where(F.col("ev_id") % 7 == 0).select(
        codecs.stable_uuid(F.col("ev_id")).alias("id"), codecs.content_digest(codecs.utf8(F.col("queue")), codecs.utf8(old)).alias("digest")
    )


@query(
    "apply_inbox",
    """SELECT id, "offset", digest FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "offset") AS rn FROM deliveries) WHERE rn = 1 AND id NOT IN (SELECT id FROM receipts)""",
    uses="deliveries receipts",
)
def apply_inbox_q(spark, folder):
    return inbox.apply_inbox(deliveries(spark, folder), receipts(spark, folder)).select("id", "offset", "digest")


@query("digest", 'SELECT id, "offset", digest FROM deliveries', uses="deliveries")
def digest_q(spark, folder):
    return deliveries(spark, folder).select("id", "offset", "digest")


@query(
    "inbox_conflicts",
    """SELECT d.id, count(*) AS deliveries, count(DISTINCT d.digest) > 1 AS in_log, min(d.digest) <> min(r.digest) AS against_receipt FROM deliveries d LEFT JOIN receipts r USING (id)
    GROUP BY d.id HAVING count(DISTINCT d.digest) > 1 OR min(d.digest) <> min(r.digest)""",
    uses="deliveries receipts",
)
def inbox_conflicts_q(spark, folder):
    return inbox.inbox_conflicts(deliveries(spark, folder), receipts(spark, folder))


@query(
    "replay_identity",
    """SELECT id, count(*) AS copies, count(DISTINCT digest) AS contents FROM deliveries GROUP BY 1 HAVING count(*) > 1""",
    uses="deliveries",
)
def replay_identity_q(spark, folder):
    from sparkcdc.streaming.relay import replay_check

    return replay_check(deliveries(spark, folder).withColumn("headers", F.lit(None).cast("array<struct<key:string,value:binary>>")))


@query(
    "materialize",
    """SELECT o_orderkey + CASE WHEN o_orderkey % 5 = 0 THEN 100000000 ELSE 0 END AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 6 <> 1""",
)
def materialize_q(spark, folder):
    orders = fx.table(spark, folder, "orders")
    k = F.col("o_orderkey")
    moved = k + F.when(k % 5 == 0, 100_000_000).otherwise(0)
    status = F.when(k % 3 == 0, F.lit("new")).otherwise(F.col("o_orderstatus"))

    def image(key, text):
        return F.struct(key.alias("id"), text.alias("status"))

    none = F.lit(None).cast("struct<id:bigint,status:string>")
    first, second, third = image(k, F.col("o_orderstatus")), image(k, status), image(moved, status)
    steps = F.array(
        F.struct((k * 4 + 1).alias("ev_id"), F.lit("INSERT").alias("op"), none.alias("old"), first.alias("new")),
        F.struct((k * 4 + 2).alias("ev_id"), F.lit("UPDATE").alias("op"), first.alias("old"), second.alias("new")),
        F.struct((k * 4 + 3).alias("ev_id"), F.lit("UPDATE").alias("op"), second.alias("old"), third.alias("new")),
        F.struct((k * 4 + 4).alias("ev_id"), F.lit("DELETE").alias("op"), third.alias("old"), none.alias("new")),
    )
    kept = F.filter(steps, lambda s: (s["op"] != "DELETE") | (k % 6 == 1))
    return inbox.materialize(orders.select(F.inline(kept)), ["id"])
