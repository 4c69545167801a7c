"""Ticks and batches over the derived event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcdc.operators import batches, ticks
from sparkcdc.plans import fixtures as fx
from sparkcdc.plans.registry import query

VISIBLE = "(e.ev_txid < t.xmin OR (e.ev_txid < t.xmax AND NOT list_contains(t.xip, e.ev_txid)))"

# The batch of each committed event, by trying every tick.
fx.CTE["assigned"] = (
    ["evc", "ticks"],
    f"SELECT e.*, b.batch_tick FROM evc e JOIN (SELECT e.ev_txid, min(t.tick_id) AS batch_tick "
    f"FROM (SELECT DISTINCT ev_txid FROM evc) e, ticks t WHERE {VISIBLE} GROUP BY 1) b USING (ev_txid)",
)


def assigned(spark, folder):
    return batches.assign_batches(fx.committed_events(spark, folder), fx.ticks(spark, folder))


@query(
    "assign_batches",
    """SELECT batch_tick, count(*) AS n, min(ev_id) AS first_id, max(ev_id) AS last_id,
    count(*) FILTER (WHERE ev_txid < 1000 + 50 * (batch_tick - 1)) AS late FROM assigned GROUP BY 1""",
    uses="assigned",
)
def assign_batches_q(spark, folder):
    late = F.col("ev_txid") < fx.TXID_BASE + fx.TICK_SPAN * (F.col("batch_tick") - 1)
    return (
        assigned(spark, folder)
        .groupBy("batch_tick")
        .agg(
            F.count("*").alias("n"),
            F.min("ev_id").alias("first_id"),
            F.max("ev_id").alias("last_id"),
            F.count_if(late).alias("late"),
        )
    )


@query(
    "tick_snapshot",
    """SELECT tick_id, tick_time, event_seq, xmin, xmax, array_to_string(xip, ',') AS xip FROM ticks
    WHERE xmax <= (SELECT max(txid) + 1 FROM tx)
    UNION ALL SELECT tick_id, tick_time, event_seq, least(xmin, (SELECT max(txid) + 1 FROM tx)),
    (SELECT max(txid) + 1 FROM tx), array_to_string(xip, ',') FROM ticks WHERE xmax > (SELECT max(txid) + 1 FROM tx)""",
    uses="ticks",
)
def tick_snapshot_q(spark, folder):
    snaps = ticks.tick_snapshot(fx.transactions(spark, folder), fx.tick_moments(spark, folder))
    return snaps.withColumn("xip", F.array_join(F.col("xip").cast("array<string>"), ","))


def assigned_open(spark, folder):
    """Events of every subscription's open window."""
    subs = fx.subscriptions(spark, folder)
    return batches.window_events(assigned(spark, folder), subs)


fx.CTE["windows"] = (
    ["assigned", "subs"],
    """SELECT a.*, s.sub_id, s.batch_id FROM assigned a JOIN subs s ON s.queue = a.queue AND a.batch_tick > s.last_tick
    AND a.batch_tick <= s.next_tick AND (a.ev_owner IS NULL OR a.ev_owner = s.sub_id)""",
)
fx.CTE["eqconf"] = (
    [],
    """SELECT DISTINCT 'q' || (s_suppkey % 3) AS queue, CAST(CASE s_suppkey % 3 WHEN 0 THEN 5 WHEN 1 THEN 3 END AS INTEGER)
    AS max_retries, s_suppkey % 3 = 1 AS disabled FROM supplier""",
)


def event_queues(spark, folder):
    k = F.col("s_suppkey") % 3
    return (
        fx.table(spark, folder, "supplier")
        .select(
            F.concat(F.lit("q"), k.cast("string")).alias("queue"),
            F.when(k == 0, 5).when(k == 1, 3).cast("int").alias("max_retries"),
            (k == 1).alias("disabled"),
        )
        .distinct()
    )


@query(
    "visible_pairs",
    """SELECT tick_id, count(*) AS n_near, count(*) FILTER (WHERE seen) AS n_seen, coalesce(sum(txid) FILTER (WHERE seen), 0)::BIGINT AS sum_seen
    FROM (SELECT t.tick_id, x.txid, (x.txid < t.xmin OR (x.txid < t.xmax AND NOT list_contains(t.xip, x.txid))) AS seen
      FROM tx x JOIN ticks t ON t.tick_id BETWEEN (x.txid - 1000) // 50 AND (x.txid - 1000) // 50 + 3) GROUP BY 1""",
    uses="tx ticks",
)
def visible_pairs_q(spark, folder):
    near = F.expr("sequence((txid - 1000) div 50, (txid - 1000) div 50 + 3)")
    pairs = fx.transactions(spark, folder).select("txid", F.explode(near).alias("tick_id")).join(fx.ticks(spark, folder), "tick_id")
    seen = pairs.withColumn("seen", batches.visible(F.col("txid"), F.col("xmin"), F.col("xmax"), F.col("xip")))
    return seen.groupBy("tick_id").agg(
        F.count("*").alias("n_near"),
        F.count_if("seen").alias("n_seen"),
        F.coalesce(F.sum(F.when(F.col("seen"), F.col("txid"))), F.lit(0)).alias("sum_seen"),
    )


def pair_of(spark, folder, tick_id):
    """Two neighbouring snapshots as plain values: the plan's literals."""
    rows = fx.ticks(spark, folder).where(F.col("tick_id").isin(tick_id, tick_id + 1)).orderBy("tick_id").take(2)
    return [{"xmin": r["xmin"], "xmax": r["xmax"], "xip": list(r["xip"])} for r in rows]


ONE_BATCH = """SELECT e.* FROM evc e, ticks t, ticks l WHERE t.tick_id = 7 AND l.tick_id = 6 AND %s
    AND NOT (e.ev_txid < l.xmin OR (e.ev_txid < l.xmax AND NOT list_contains(l.xip, e.ev_txid)))
    AND (e.ev_owner IS NULL OR e.ev_owner = 8)""" % VISIBLE


@query(
    "batch_events",
    f"SELECT ev_id, ev_txid, ev_retry, ev_type, ev_data FROM ({ONE_BATCH})",
    uses="evc ticks",
)
def batch_events_q(spark, folder):
    last, cur = pair_of(spark, folder, 6)
    rows = batches.batch_events(fx.committed_events(spark, folder), last, cur, sub_id=8)
    return rows.select("ev_id", "ev_txid", "ev_retry", "ev_type", "ev_data")


@query(
    "batch_cursor",
    f"SELECT ev_id, ev_data FROM ({ONE_BATCH}) WHERE ev_type = 'click' ORDER BY ev_id LIMIT 10",
    uses="evc ticks",
)
def batch_cursor_q(spark, folder):
    last, cur = pair_of(spark, folder, 6)
    rows = batches.batch_events(fx.committed_events(spark, folder), last, cur, sub_id=8)
    return batches.batch_cursor(rows, 10, "ev_type = 'click'").select("ev_id", "ev_data")


@query(
    "window_events",
    """SELECT sub_id, count(*) AS n, min(ev_id) AS first_id, max(ev_id) AS last_id, count(ev_owner) AS owned
    FROM windows GROUP BY 1""",
    uses="windows",
)
def window_events_q(spark, folder):
    return (
        assigned_open(spark, folder)
        .groupBy("sub_id")
        .agg(
            F.count("*").alias("n"),
            F.min("ev_id").alias("first_id"),
            F.max("ev_id").alias("last_id"),
            F.count("ev_owner").alias("owned"),
        )
    )


@query(
    "tx_ranges",
    """WITH pairs AS (SELECT tick_id, xmax, xip, lag(xmax) OVER w AS last_xmax, lag(xip) OVER w AS last_xip FROM ticks WINDOW w AS (ORDER BY tick_id)),
    ended AS (SELECT tick_id, last_xmax, x FROM (SELECT tick_id, last_xmax, xip, unnest(last_xip) AS x FROM pairs) WHERE NOT list_contains(xip, x)),
    steps AS (SELECT *, coalesce(lag(x) OVER w, last_xmax) - x <= 20 AS near FROM ended WINDOW w AS (PARTITION BY tick_id ORDER BY x DESC)),
    runs AS (SELECT *, bool_and(near) OVER (PARTITION BY tick_id ORDER BY x DESC) AS inside FROM steps)
    SELECT p.tick_id, coalesce(min(r.x) FILTER (WHERE r.inside), p.last_xmax) AS tx_start, p.xmax AS tx_end,
    coalesce(string_agg(CAST(r.x AS VARCHAR), ',' ORDER BY r.x DESC) FILTER (WHERE NOT r.inside), '') AS tx_list
    FROM pairs p LEFT JOIN runs r USING (tick_id) WHERE p.last_xmax IS NOT NULL GROUP BY p.tick_id, p.last_xmax, p.xmax""",
    uses="ticks",
)
def tx_ranges_q(spark, folder):
    ranges = batches.tx_ranges(batches.tick_pairs(fx.ticks(spark, folder)), near=20)
    return ranges.select("tick_id", "tx_start", "tx_end", F.array_join(F.col("tx_list").cast("array<string>"), ",").alias("tx_list"))


@query(
    "next_batch",
    """SELECT s.queue, s.sub_id, s.last_tick AS prev_tick, s.batch_id IS NOT NULL AS reopened,
    CASE WHEN s.batch_id IS NOT NULL THEN s.next_tick
      ELSE (SELECT min(t.tick_id) FROM ticks t WHERE t.tick_id > s.last_tick AND t.tick_id = (SELECT min(u.tick_id) FROM ticks u WHERE u.tick_id > s.last_tick)
        AND t.tick_time <= TIMESTAMP '2024-01-01 00:40:00' - INTERVAL 5 MINUTE) END AS cur_tick FROM subs s""",
    uses="subs ticks",
)
def next_batch_q(spark, folder):
    return batches.next_batch(fx.subscriptions(spark, folder), fx.queue_ticks(spark, folder), "2024-01-01 00:40:00", 300)


@query(
    "find_tick",
    """SELECT s.queue, s.sub_id, CASE WHEN n.tick_id <= s.last_tick THEN NULL
      WHEN n.event_seq - c.event_seq > 600 OR n.tick_time - c.tick_time > INTERVAL 10 MINUTE THEN
        (SELECT min(t.tick_id) FROM ticks t WHERE t.tick_id > s.last_tick AND (t.event_seq - c.event_seq >= 300 OR t.tick_time - c.tick_time >= INTERVAL 5 MINUTE))
      WHEN n.event_seq - c.event_seq >= 300 OR n.tick_time - c.tick_time >= INTERVAL 5 MINUTE THEN n.tick_id END AS found_tick
    FROM subs s JOIN ticks c ON c.tick_id = s.last_tick, (SELECT * FROM ticks ORDER BY tick_id DESC LIMIT 1) n""",
    uses="subs ticks",
)
def find_tick_q(spark, folder):
    return batches.find_tick(fx.subscriptions(spark, folder), fx.queue_ticks(spark, folder), 300, 300_000_000)


RECEIVED = """opened AS (SELECT queue, sub_id, last_tick, coalesce(next_tick, (SELECT min(t.tick_id) FROM ticks t WHERE t.tick_id > s.last_tick)) AS cur
      FROM subs s), o AS (SELECT * FROM opened WHERE cur IS NOT NULL),
    got AS (SELECT o.queue, o.sub_id, a.ev_id, a.ev_data, row_number() OVER (PARTITION BY o.sub_id ORDER BY a.ev_id) AS rn
      FROM o JOIN assigned a ON a.queue = o.queue AND a.batch_tick > o.last_tick AND a.batch_tick <= o.cur AND (a.ev_owner IS NULL OR a.ev_owner = o.sub_id))"""


@query("receive", f"WITH {RECEIVED} SELECT queue, sub_id, ev_id, ev_data FROM got WHERE rn <= 3", uses="assigned subs ticks")
def receive_q(spark, folder):
    rows, _ = batches.receive(fx.subscriptions(spark, folder), fx.queue_ticks(spark, folder), assigned(spark, folder), 3)
    return rows.select("queue", "sub_id", "ev_id", "ev_data")


@query(
    "receive_cursors",
    f"""WITH {RECEIVED} SELECT o.queue, o.sub_id, count(g.ev_id) AS in_batch,
    CASE WHEN count(g.ev_id) > 0 THEN o.last_tick ELSE o.cur END AS last_tick, CASE WHEN count(g.ev_id) > 0 THEN o.cur END AS next_tick
    FROM o LEFT JOIN got g USING (queue, sub_id) GROUP BY o.queue, o.sub_id, o.last_tick, o.cur""",
    uses="assigned subs ticks",
)
def receive_cursors_q(spark, folder):
    return batches.receive(fx.subscriptions(spark, folder), fx.queue_ticks(spark, folder), assigned(spark, folder), 3)[1]


@query(
    "ack_batch",
    """SELECT queue, sub_id, CASE WHEN a THEN next_tick ELSE last_tick END AS last_tick, CASE WHEN NOT a THEN next_tick END AS next_tick,
    CASE WHEN NOT a THEN batch_id END AS batch_id, a AS acked
    FROM (SELECT *, coalesce(batch_id % 3 = 0, false) AS a FROM subs)""",
    uses="subs",
)
def ack_batch_q(spark, folder):
    # Ids nobody holds are part of the request and must change nothing.
    asked = fx.table(spark, folder, "customer").select((F.col("c_custkey") + 1).alias("batch_id")).where(F.col("batch_id") % 3 == 0)
    return batches.ack_batch(fx.subscriptions(spark, folder), asked)


@query(
    "subscribe_at",
    """WITH req AS (SELECT queue, CAST(CASE WHEN sub_id % 2 = 0 THEN sub_id ELSE sub_id + 1000000 END AS INTEGER) AS sub_id,
      CASE sub_id % 3 WHEN 0 THEN NULL WHEN 1 THEN sub_id % 40 + 1 ELSE sub_id % 90 + 1 END AS at_tick FROM subs),
    ok AS (SELECT *, at_tick IS NULL OR at_tick <= (SELECT max(tick_id) FROM ticks) AS fine FROM req)
    SELECT coalesce(s.queue, r.queue) AS queue, coalesce(s.sub_id, r.sub_id) AS sub_id,
    CASE WHEN r.fine AND r.at_tick IS NOT NULL THEN r.at_tick WHEN s.sub_id IS NOT NULL THEN s.last_tick
      WHEN r.fine THEN (SELECT max(tick_id) FROM ticks) END AS last_tick,
    CASE WHEN s.sub_id IS NOT NULL AND NOT coalesce(r.fine AND r.at_tick IS NOT NULL, false) THEN s.next_tick END AS next_tick,
    CASE WHEN s.sub_id IS NOT NULL AND NOT coalesce(r.fine AND r.at_tick IS NOT NULL, false) THEN s.batch_id END AS batch_id,
    CASE WHEN NOT r.fine THEN 'tick not found' END AS reason
    FROM subs s FULL JOIN ok r ON r.queue = s.queue AND r.sub_id = s.sub_id""",
    uses="subs ticks",
)
def subscribe_q(spark, folder):
    subs = fx.subscriptions(spark, folder)
    k = F.col("sub_id")
    asked = subs.select(
        "queue",
        F.when(k % 2 == 0, k).otherwise(k + 1_000_000).cast("int").alias("sub_id"),
        F.when(k % 3 == 1, k % 40 + 1).when(k % 3 == 2, k % 90 + 1).cast("bigint").alias("at_tick"),
    )
    return batches.subscribe(subs, asked, fx.queue_ticks(spark, folder))


@query(
    "unsubscribe",
    """WITH two AS (SELECT queue, sub_id, consumer FROM subs UNION ALL
      SELECT 'q' || ((sub_id + 1) % 3), CAST(sub_id + 500000 AS INTEGER), consumer FROM subs WHERE sub_id % 5 = 0),
    leaving AS (SELECT queue, consumer FROM subs WHERE sub_id % 2 = 0),
    kept AS (SELECT * FROM two WHERE (queue, consumer) NOT IN (SELECT queue, consumer FROM leaving)),
    gone AS (SELECT * FROM two WHERE (queue, consumer) IN (SELECT queue, consumer FROM leaving))
    SELECT 'subscription' AS kind, queue, CAST(sub_id AS BIGINT) AS id FROM kept
    UNION ALL SELECT 'retry', queue, ev_id FROM retry WHERE (queue, ev_owner) NOT IN (SELECT queue, sub_id FROM gone)
    UNION ALL SELECT 'dead letter', queue, dl_id FROM dead WHERE consumer NOT IN
      (SELECT consumer FROM leaving WHERE consumer NOT IN (SELECT consumer FROM kept))""",
    uses="subs retry dead",
)
def unsubscribe_q(spark, folder):
    subs = fx.subscriptions(spark, folder).select("queue", "sub_id", "consumer")
    k = F.col("sub_id")
    second = subs.where(k % 5 == 0).select(
        F.concat(F.lit("q"), ((k + 1) % 3).cast("string")).alias("queue"), (k + 500_000).cast("int").alias("sub_id"), "consumer"
    )
    kept, waiting, letters = batches.unsubscribe(
        subs.unionByName(second), fx.retries(spark, folder), fx.dead_letters(spark, folder), subs.where(k % 2 == 0)
    )
    parts = [("subscription", kept, k.cast("bigint")), ("retry", waiting, F.col("ev_id")), ("dead letter", letters, F.col("dl_id"))]
    frames = [df.select(F.lit(kind).alias("kind"), "queue", key.alias("id")) for kind, df, key in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "fetch_size",
    """SELECT batch_tick, max_bytes, least(1000, greatest(1, 4000 // greatest(1, max_bytes))) AS fetch_rows
    FROM (SELECT batch_tick, max(strlen(ev_data)) AS max_bytes FROM assigned GROUP BY 1)""",
    uses="assigned",
)
def fetch_size_q(spark, folder):
    return batches.fetch_size(assigned(spark, folder), 1000, 4000)


@query(
    "drain_batch",
    """SELECT t.tick_id, count(a.ev_id) AS n, min(a.ev_id) AS first_id, max(a.ev_id) AS last_id
    FROM ticks t LEFT JOIN assigned a ON a.batch_tick = t.tick_id GROUP BY 1""",
    uses="assigned ticks",
)
def drain_batch_q(spark, folder):
    return batches.drain_batch(assigned(spark, folder), fx.ticks(spark, folder))


@query(
    "external_tick_check",
    """WITH offers AS (SELECT 's' || (event_id % 120) AS queue, event_id AS arrival,
      event_id // 120 * 10 - CASE WHEN event_id % 31 = 0 THEN 15 ELSE 0 END + 20 AS tick_id,
      event_id - CASE WHEN event_id % 37 = 0 THEN 200 ELSE 0 END AS event_seq FROM events),
    o AS (SELECT o.*, q.external, q.paused, coalesce(q.external AND NOT q.paused, false) AS usable FROM offers o LEFT JOIN queues q USING (queue)),
    m AS (SELECT *, max(tick_id) FILTER (WHERE usable) OVER w AS mt, max(event_seq) FILTER (WHERE usable) OVER w AS ms
      FROM o WINDOW w AS (PARTITION BY queue ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT queue, arrival, tick_id, event_seq, CASE WHEN external IS NULL THEN 'queue not found' WHEN paused THEN 'paused'
      WHEN NOT external THEN 'not external' WHEN tick_id <= coalesce(mt, 0) THEN 'tick id not rising' WHEN event_seq < ms THEN 'event seq falls' END AS reason FROM m""",
    uses="queues",
)
def external_tick_check_q(spark, folder):
    k = F.col("event_id")
    offers = fx.table(spark, folder, "events").select(
        F.concat(F.lit("s"), (k % 120).cast("string")).alias("queue"),
        k.alias("arrival"),
        (F.expr("event_id div 120") * 10 - F.when(k % 31 == 0, 15).otherwise(0) + 20).alias("tick_id"),
        (k - F.when(k % 37 == 0, 200).otherwise(0)).alias("event_seq"),
    )
    return ticks.external_tick_check(offers, fx.queue_configs(spark, folder))


@query(
    "queue_config_check",
    """SELECT queue, name, value, CASE WHEN name NOT IN ('ticker_max_count','ticker_max_lag','ticker_idle_period','rotation_period','max_retries',
      'ticker_paused','external_ticker') THEN 'unknown setting' WHEN value IS NULL THEN NULL
      WHEN name = 'ticker_paused' THEN CASE WHEN TRY_CAST(value AS BOOLEAN) IS NULL THEN 'not a boolean' END
      WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN 'not a number'
      WHEN name = 'max_retries' AND CAST(value AS DOUBLE) < 0 THEN 'must be >= 0'
      WHEN name <> 'max_retries' AND CAST(value AS DOUBLE) <= 0 THEN 'must be > 0' END AS reason
    FROM (SELECT 'c' || c_custkey AS queue, CASE c_custkey % 7 WHEN 0 THEN 'ticker_max_count' WHEN 1 THEN 'ticker_max_lag' WHEN 2 THEN 'ticker_idle_period'
        WHEN 3 THEN 'rotation_period' WHEN 4 THEN 'max_retries' WHEN 5 THEN 'ticker_paused' ELSE 'colour' END AS name,
      CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 5 THEN CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'maybe' END
        ELSE CAST(c_custkey % 9 - 4 AS VARCHAR) END AS value FROM customer)""",
)
def queue_config_check_q(spark, folder):
    k = F.col("c_custkey")
    names = ["ticker_max_count", "ticker_max_lag", "ticker_idle_period", "rotation_period", "max_retries", "ticker_paused", "colour"]
    settings = fx.table(spark, folder, "customer").select(
        F.concat(F.lit("c"), k.cast("string")).alias("queue"),
        F.element_at(F.array(*[F.lit(n) for n in names]), (k % 7 + 1).cast("int")).alias("name"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 5, F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("maybe")))
        .otherwise((k % 9 - 4).cast("string"))
        .alias("value"),
    )
    return ticks.queue_config_check(settings)


POLL_SECONDS = 1800

CLOSED = """polls AS (SELECT queue, at_us, max(top) OVER (PARTITION BY queue ORDER BY at_us) AS event_seq, row_number() OVER (PARTITION BY queue ORDER BY at_us) AS n
      FROM (SELECT queue, (epoch_us(ev_time) // 1800000000 + 1) * 1800000000 AS at_us,
        max(ev_id) FILTER (WHERE ev_time < TIMESTAMP '2024-01-08' OR ev_time > TIMESTAMP '2024-01-12') AS top FROM ev GROUP BY 1, 2)),
    fold AS (SELECT queue, n, at_us, event_seq, at_us AS last_at, event_seq AS last_seq, CAST(NULL AS BIGINT) AS gap, CAST(1 AS BIGINT) AS tick_id, true AS ticked
      FROM polls WHERE n = 1
      UNION ALL SELECT queue, n, at_us, event_seq, CASE WHEN t THEN at_us ELSE last_at END, CASE WHEN t THEN event_seq ELSE last_seq END,
        CASE WHEN t THEN at_us - last_at ELSE gap END, CASE WHEN t THEN tick_id + 1 ELSE tick_id END, t
      FROM (SELECT p.queue, p.n, p.at_us, p.event_seq, f.last_at, f.last_seq, f.gap, f.tick_id,
        %s CASE WHEN p.event_seq > f.last_seq THEN p.event_seq - f.last_seq >= 40 OR p.at_us - f.last_at >= 7200000000
          ELSE f.gap IS NULL OR NOT ((p.at_us - f.last_at) * 2 < 7200000000 OR (p.at_us - f.last_at < f.gap * 2 AND p.at_us - f.last_at < 28800000000)) END AS t
        FROM fold f JOIN polls p ON p.queue = f.queue AND p.n = f.n + 1))"""


def polls_and_queues(spark, folder):
    ev = fx.events(spark, folder)
    # A quiet stretch: polls go on, no new ids are handed out.
    quiet = (F.col("ev_time") < "2024-01-08") | (F.col("ev_time") > "2024-01-12")
    polls = ticks.poll_counts(ev.withColumn("ev_id", F.when(quiet, F.col("ev_id"))), POLL_SECONDS)
    queues = event_queues(spark, folder).select(
        "queue",
        F.lit(40).alias("max_count"),
        F.lit(7_200_000_000).alias("max_lag_us"),
        F.lit(28_800_000_000).alias("idle_us"),
        F.lit(False).alias("paused"),
        F.lit(False).alias("external"),
    )
    return polls, queues


@query(
    "close_batches",
    "WITH RECURSIVE " + CLOSED % "" + " SELECT queue, tick_id, at_us, event_seq FROM fold WHERE ticked",
    uses="ev",
)
def close_batches_q(spark, folder):
    return ticks.close_batches(*polls_and_queues(spark, folder))


@query(
    "force_close",
    "WITH RECURSIVE " + CLOSED % "(p.queue = 'q1' AND p.at_us = 1704844800000000) OR" + " SELECT queue, tick_id, at_us, event_seq FROM fold WHERE ticked",
    uses="ev",
)
def force_close_q(spark, folder):
    polls, queues = polls_and_queues(spark, folder)
    return ticks.close_batches(ticks.force_close(polls, "q1", 1704844800000000), queues)
