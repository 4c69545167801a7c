"""Reconciliation, run reports and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcdc.functions import codecs
from sparkcdc.operators import monitor, reconcile
from sparkcdc.operators.envelope import legacy_envelope
from sparkcdc.plans import fixtures as fx
from sparkcdc.plans.registry import query

NOW = "2024-02-01 00:00:00"

fx.CTE["ledger"] = ([], "SELECT event_id AS id, epoch_us(ts) * 1000 AS sent_ns, sha256(props) AS checksum, props FROM events")
fx.CTE["received"] = (
    ["ledger"],
    """SELECT id, sent_ns, CASE WHEN id % 103 = 0 THEN sha256(props || 'x') ELSE checksum END AS checksum, sent_ns + (id % 500) * 1000000 AS recv_ns FROM ledger WHERE id % 101 <> 0
    UNION ALL SELECT 10000000 + id, sent_ns, checksum, sent_ns + 1 FROM ledger WHERE id % 107 = 0
    UNION ALL SELECT id, sent_ns, CASE WHEN id % 1090 = 0 THEN sha256(props || 'y') WHEN id % 103 = 0 THEN sha256(props || 'x') ELSE checksum END,
      sent_ns + (id % 500) * 1000000 + 7 FROM ledger WHERE id % 109 = 0 AND id % 101 <> 0""",
)
fx.CTE["compared"] = (
    ["received"],
    """SELECT coalesce(e.id, r.id) AS id, CASE WHEN r.id IS NULL THEN 'missing' WHEN e.id IS NULL THEN 'phantom' WHEN r.sent_ns <> e.sent_ns OR r.checksum <> e.checksum THEN 'corrupt' ELSE 'ok' END AS status,
    coalesce(r.n - 1, 0) AS duplicates, coalesce(r.kinds > 1, false) AS changed, CASE WHEN r.sent_ns = e.sent_ns AND r.checksum = e.checksum THEN r.recv_ns - e.sent_ns END AS latency_ns
    FROM ledger e FULL JOIN (SELECT id, min(recv_ns) AS recv_ns, arg_min(sent_ns, recv_ns) AS sent_ns, arg_min(checksum, recv_ns) AS checksum, count(*) AS n, count(DISTINCT checksum) AS kinds FROM received GROUP BY 1) r
    ON r.id = e.id""",
)


def ledger(spark, folder):
    return fx.table(spark, folder, "events").select(
        F.col("event_id").alias("id"), (F.unix_micros("ts") * 1000).alias("sent_ns"), F.sha2("props", 256).alias("checksum"), "props"
    )


def received(spark, folder):
    rows = ledger(spark, folder)
    k = F.col("id")

    def spoiled(mark):
        return F.sha2(F.concat("props", F.lit(mark)), 256)

    kept = rows.where(k % 101 != 0)
    checksum = F.when(k % 103 == 0, spoiled("x")).otherwise(F.col("checksum"))
    arrived = F.col("sent_ns") + (k % 500) * 1_000_000
    first = kept.select("id", "sent_ns", checksum.alias("checksum"), arrived.alias("recv_ns"))
    phantoms = rows.where(k % 107 == 0).select((k + 10_000_000).alias("id"), "sent_ns", "checksum", (F.col("sent_ns") + 1).alias("recv_ns"))
    again = kept.where(k % 109 == 0).select(
        "id", "sent_ns", F.when(k % 1090 == 0, spoiled("y")).otherwise(checksum).alias("checksum"), (arrived + 7).alias("recv_ns")
    )
    return first.unionByName(phantoms).unionByName(again)


def compared(spark, folder):
    return reconcile.reconcile_rows(ledger(spark, folder).drop("props"), received(spark, folder))


@query("reconcile_rows", "SELECT id, status, duplicates, changed, latency_ns FROM compared", uses="compared")
def reconcile_rows_q(spark, folder):
    return compared(spark, folder)


@query(
    "reconcile",
    """SELECT count(*) FILTER (WHERE status <> 'phantom') AS expected, count(*) FILTER (WHERE status = 'missing') AS missing, count(*) FILTER (WHERE status = 'corrupt') AS corrupt,
    count(*) FILTER (WHERE status = 'phantom') AS phantoms, CAST(sum(duplicates) AS BIGINT) AS duplicates, count(*) FILTER (WHERE changed) AS changed_duplicates FROM compared""",
    uses="compared",
)
def reconcile_q(spark, folder):
    return reconcile.reconcile(compared(spark, folder))


@query(
    "wire_check",
    """SELECT o_orderkey, CASE o_orderkey % 12 WHEN 1 THEN 'value too short' WHEN 2 THEN 'key differs' WHEN 3 THEN 'one header expected' WHEN 4 THEN 'id header differs' END AS reason,
    CASE WHEN o_orderkey % 12 <> 1 THEN o_orderkey END AS id, CASE WHEN o_orderkey % 12 <> 1 THEN o_custkey END AS sent_ns, CASE WHEN o_orderkey % 12 = 1 THEN '' ELSE o_orderpriority END AS payload FROM orders""",
)
def wire_check_q(spark, folder):
    k = F.col("o_orderkey")
    m = k % 12
    whole = F.concat(codecs.int8_bytes(k), codecs.int8_bytes(F.col("o_custkey")), codecs.utf8(F.col("o_orderpriority")))
    header = F.struct(F.lit("id").alias("key"), codecs.utf8(codecs.stable_uuid(F.when(m == 4, k + 1).otherwise(k))).alias("value"))
    records = fx.table(spark, folder, "orders").select(
        "o_orderkey",
        codecs.utf8(F.when(m == 2, k + 1).otherwise(k).cast("string")).alias("key"),
        F.when(m == 1, F.unhex(F.lit("00"))).otherwise(whole).alias("value"),
        F.when(m == 3, F.array(header, header)).otherwise(F.array(header)).alias("headers"),
    )
    return reconcile.wire_check(records).select("o_orderkey", "reason", "id", "sent_ns", "payload")


RANKS = """max(v) FILTER (WHERE rn = (n - 1) * 50 // 100) AS p50, max(v) FILTER (WHERE rn = (n - 1) * 95 // 100) AS p95, max(v) FILTER (WHERE rn = (n - 1) * 99 // 100) AS p99, max(v) AS max, max(n) AS n"""


@query(
    "latency_profile",
    f"""SELECT g, {RANKS} FROM (SELECT id % 4 AS g, latency_ns AS v, row_number() OVER (PARTITION BY id % 4 ORDER BY latency_ns) - 1 AS rn, count(*) OVER (PARTITION BY id % 4) AS n
      FROM compared WHERE latency_ns IS NOT NULL AND id > 300) GROUP BY 1""",
    uses="compared",
)
def latency_profile_q(spark, folder):
    rows = compared(spark, folder).withColumn("g", F.col("id") % 4)
    return reconcile.latency_profile(rows, ["g"], "latency_ns", 50_000_000, warmup=F.col("id") <= 300)


ADMITTED = """SELECT i, u, epoch_us(ts) AS actual_us, 1704067200000000 + CAST(i AS BIGINT) * 1000000 // 2 AS scheduled_us, epoch_us(ts) - (1704067200000000 + CAST(i AS BIGINT) * 1000000 // 2) AS delay_us
    FROM (SELECT event_id AS i, user_id % 3 AS u, ts FROM events)"""


def admitted(spark, folder):
    rows = fx.table(spark, folder, "events").select(
        F.col("event_id").alias("i"), (F.col("user_id") % 3).alias("u"), F.unix_micros("ts").alias("actual_us")
    )
    return reconcile.admission_delay(rows, F.lit(1_704_067_200_000_000), 2)


@query("admission_delay", ADMITTED)
def admission_delay_q(spark, folder):
    return admitted(spark, folder)


@query(
    "admission_profile",
    f"""SELECT u, {RANKS} FROM (SELECT u, delay_us AS v, row_number() OVER (PARTITION BY u ORDER BY delay_us) - 1 AS rn, count(*) OVER (PARTITION BY u) AS n FROM ({ADMITTED})) GROUP BY 1""",
)
def admission_profile_q(spark, folder):
    return reconcile.latency_profile(admitted(spark, folder), ["u"], "delay_us", 60_000_000_000)


def documents(spark, folder):
    """One result document per user and thousand events, so that a document stays small."""
    u = F.col("user_id")
    ev = fx.table(spark, folder, "events")
    block = F.expr("event_id div 1000").alias("block")
    case = F.concat(
        F.when(u % 2 == 0, F.lit("steady-")).otherwise(F.lit("held-")), u.cast("string"), F.lit("-"), F.col("block").cast("string")
    )
    error = F.col("event_type") == "error"
    sample = F.struct(
        F.col("event_id").cast("double").alias("elapsed_s"),
        (F.col("event_id") * 0.5 + F.col("value")).alias("cpu_seconds"),
        F.col("value").alias("memory_mib"),
        F.col("value").alias("anonymous_mib"),
        F.when(u % 3 == 0, F.col("value")).alias("process_rss_mib"),
    )
    per_run = ev.groupBy("user_id", block).agg(
        F.count("*").alias("committed"),
        F.count_if(error & (F.col("event_id") % 101 == 0)).alias("missing"),
        F.count_if(error & (F.col("event_id") % 103 == 0)).alias("corrupt"),
        F.count_if(error & (F.col("event_id") % 107 == 0)).alias("phantoms"),
        F.max("event_id").alias("top"),
        F.max("value").alias("worst"),
        # At most a thousand samples: the block bounds the group.
        F.collect_list(sample).alias("all_samples"),
    )
    document = F.struct(
        F.concat(F.lit("m"), (u % 4).cast("string")).alias("mode"),
        F.lit(1000).alias("rate"),
        F.when(u % 5 == 0, F.col("committed") * 10).otherwise(0).alias("prepared_backlog"),
        "committed",
        (F.col("committed") - 1).alias("measured_committed"),
        "missing",
        "corrupt",
        "phantoms",
        F.lit(0).alias("duplicates"),
        (u % 17 != 0).alias("source_ack_complete"),
        F.lit(8.0).alias("producer_elapsed_s"),
        F.lit(2.0).alias("recovery_s"),
        (F.col("top") * 1000).alias("queue_bytes"),
        F.struct(F.col("worst").alias("p50"), F.col("worst").alias("p95"), F.col("worst").alias("p99"), F.col("worst").alias("max")).alias(
            "latency_tx_start_to_decode_ms"
        ),
        F.create_map(F.lit("relay"), F.col("all_samples")).alias("samples"),
    )
    return per_run.select(case.alias("case"), F.to_json(document).alias("document"))


def runs(spark, folder):
    return reconcile.read_runs(documents(spark, folder))


fx.CTE["runs"] = (
    [],
    """SELECT user_id AS u, CASE WHEN user_id % 2 = 0 THEN 'steady-' ELSE 'held-' END || user_id || '-' || (event_id // 1000) AS "case", 'm' || (user_id % 4) AS mode, count(*) AS committed,
    count(*) FILTER (WHERE event_type = 'error' AND event_id % 101 = 0) AS missing, count(*) FILTER (WHERE event_type = 'error' AND event_id % 103 = 0) AS corrupt,
    count(*) FILTER (WHERE event_type = 'error' AND event_id % 107 = 0) AS phantoms, max(event_id) AS top, max(value) AS worst FROM events GROUP BY user_id, event_id // 1000""",
)
fx.CTE["summary"] = (
    ["runs"],
    """SELECT u, "case", mode, CAST(1000 AS BIGINT) AS rate, missing = 0 AND corrupt = 0 AND phantoms = 0 AND u % 17 <> 0 AS correct, committed, CAST(0 AS BIGINT) AS duplicates,
    (committed - 1) / 8.0::DOUBLE AS events_per_s, worst AS latency_p99_ms, top * 1000 / 1048576.0::DOUBLE AS queue_mib, CASE WHEN u % 5 = 0 THEN 10.0::DOUBLE END AS backlog_s,
    CASE WHEN u % 5 = 0 THEN committed * 10 / 10.0::DOUBLE END AS backlog_per_s FROM runs""",
)


@query("run_summary", "SELECT * EXCLUDE (u) REPLACE (round(queue_mib, 6) AS queue_mib) FROM summary", uses="summary")
def run_summary_q(spark, folder):
    return reconcile.run_summary(runs(spark, folder)).withColumn("queue_mib", F.round("queue_mib", 6))


@query(
    "resource_use",
    """SELECT CASE WHEN user_id % 2 = 0 THEN 'steady-' ELSE 'held-' END || user_id || '-' || (event_id // 1000) AS "case", 'relay' AS part,
    CASE WHEN count(*) > 1 THEN round((arg_max(event_id * 0.5::DOUBLE + value, event_id) - arg_min(event_id * 0.5::DOUBLE + value, event_id)) / (max(event_id) - min(event_id)) * 100, 6) END AS cpu_pct_one_core,
    max(value) AS memory_peak_mib, max(value) AS anonymous_peak_mib, max(value) FILTER (WHERE user_id % 3 = 0) AS process_rss_peak_mib
    FROM events GROUP BY user_id, event_id // 1000""",
)
def resource_use_q(spark, folder):
    return reconcile.resource_use(runs(spark, folder)).withColumn("cpu_pct_one_core", F.round("cpu_pct_one_core", 6))


@query(
    "steady_medians",
    """SELECT mode, count(*) AS runs, median(events_per_s) AS events_per_s, median(latency_p99_ms) AS latency_p99_ms FROM summary WHERE "case" LIKE 'steady-%' GROUP BY 1""",
    uses="summary",
)
def steady_medians_q(spark, folder):
    return reconcile.steady_medians(reconcile.run_summary(runs(spark, folder)), ["events_per_s", "latency_p99_ms"])


@query(
    "cohort_status",
    """WITH cases AS (SELECT 'c' || (c_custkey % 25) AS cohort, CASE WHEN c_custkey % 2 = 0 THEN 'steady-' ELSE 'held-' END || (c_custkey // 5) || '-0' AS "case" FROM customer)
    SELECT cohort, count(*) AS cases, count(*) FILTER (WHERE s.correct IS NULL) AS missing_cases, min(c."case") FILTER (WHERE s.correct IS NULL) AS first_missing,
    bool_and(coalesce(s.correct, false)) AS complete FROM cases c LEFT JOIN summary s USING ("case") GROUP BY 1""",
    uses="summary",
)
def cohort_status_q(spark, folder):
    k = F.col("c_custkey")
    cases = fx.table(spark, folder, "customer").select(
        F.concat(F.lit("c"), (k % 25).cast("string")).alias("cohort"),
        F.concat(F.when(k % 2 == 0, F.lit("steady-")).otherwise(F.lit("held-")), F.expr("c_custkey div 5").cast("string"), F.lit("-0")).alias("case"),
    )
    return reconcile.cohort_status(cases, reconcile.run_summary(runs(spark, folder)))


@query(
    "latency_gates",
    """SELECT "case", correct, latency_p99_ms, CAST(CASE WHEN u % 2 = 0 THEN 250 ELSE 1000 END AS INTEGER) AS limit_ms,
    correct AND latency_p99_ms <= CASE WHEN u % 2 = 0 THEN 250 ELSE 1000 END AS passed FROM (SELECT * REPLACE (latency_p99_ms * 2 AS latency_p99_ms) FROM summary)""",
    uses="summary",
)
def latency_gates_q(spark, folder):
    summary = reconcile.run_summary(runs(spark, folder)).withColumn("latency_p99_ms", F.col("latency_p99_ms") * 2)
    return reconcile.latency_gates(summary)


@query(
    "storage_trend",
    """WITH s AS (SELECT user_id % 7 AS run, epoch_us(ts) AS t_us, epoch_us(ts) // 7200000000 AS rot, event_id % 977 * 1000 AS b FROM events),
    e AS (SELECT run, min(t_us) AS a, max(t_us) AS z, count(DISTINCT rot) AS rotations, min(b) AS min_bytes, max(b) AS max_bytes FROM s GROUP BY 1)
    SELECT run, rotations, min_bytes, max_bytes, median(b) FILTER (WHERE t_us < a + 86400000000) AS first_median, median(b) FILTER (WHERE t_us > z - 86400000000) AS last_median
    FROM s JOIN e USING (run) GROUP BY ALL""",
)
def storage_trend_q(spark, folder):
    samples = fx.table(spark, folder, "events").select(
        (F.col("user_id") % 7).alias("run"),
        F.unix_micros("ts").alias("at_us"),
        F.expr("unix_micros(ts) div 7200000000").alias("rotation_us"),
        (F.col("event_id") % 977 * 1000).alias("bytes"),
    )
    return reconcile.storage_trend(samples, ["run"], 86_400_000_000, 100_000)


@query(
    "size_profile",
    """SELECT ev_type, count(*) AS n, CAST(sum(strlen(ev_data)) AS BIGINT) AS raw_bytes,
    CAST(sum(strlen('{"headers":{"ID":"ep-1:' || ev_id || '","PARTITION_ID":"ep-1"},"payload":"' || replace(ev_data, '"', '\\"') || '"}')) AS BIGINT) AS encoded_bytes,
    CAST(max(strlen(ev_data)) AS INTEGER) AS max_raw_bytes FROM ev GROUP BY 1""",
    uses="ev",
)
def size_profile_q(spark, folder):
    encoded = legacy_envelope(F.lit("ep-1"), F.col("ev_id"), F.col("ev_data"))
    return reconcile.size_profile(fx.events(spark, folder), ["ev_type"], "ev_data", encoded)


@query(
    "top_n",
    """SELECT 'part ' || l_partkey AS query, CAST(sum(l_linenumber) AS BIGINT) AS calls, CAST(sum(CAST(l_quantity AS BIGINT) * 1000) AS BIGINT) AS total_us, max(CAST(l_quantity AS BIGINT) * 1000) AS max_us
    FROM lineitem GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 20""",
)
def top_n_q(spark, folder):
    log = fx.table(spark, folder, "lineitem").select(
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("query"),
        F.col("l_linenumber").cast("bigint").alias("calls"),
        (F.col("l_quantity").cast("bigint") * 1000).alias("total_us"),
    )
    return reconcile.top_statements(log)


LAG = "epoch_us(TIMESTAMP '2024-02-01') - epoch_us({t})"


@query(
    "queue_info",
    f"""SELECT q.queue, {LAG.format(t='n.tick_time')} AS ticker_lag_us, round((n.event_seq - o.event_seq) / ((epoch_us(n.tick_time) - epoch_us(o.tick_time)) / 1000000), 6) AS ev_per_sec,
    q.last_seq - n.event_seq AS ev_new, n.tick_id AS last_tick_id FROM (SELECT queue, max(ev_id) + 5 AS last_seq FROM ev GROUP BY 1) q,
    (SELECT * FROM ticks ORDER BY tick_id DESC LIMIT 1) n, (SELECT * FROM ticks WHERE tick_id >= (SELECT max(tick_id) FROM ticks) - 20 ORDER BY tick_id LIMIT 1) o""",
    uses="ev ticks",
)
def queue_info_q(spark, folder):
    queues = fx.events(spark, folder).groupBy("queue").agg((F.max("ev_id") + 5).alias("last_seq"))
    info = monitor.queue_info(queues, fx.queue_ticks(spark, folder), NOW)
    return info.withColumn("ev_per_sec", F.round("ev_per_sec", 6))


@query(
    "consumer_info",
    f"""SELECT s.queue, s.consumer, {LAG.format(t='t.tick_time')} AS lag_us, {LAG.format(t='s.active')} AS last_seen_us, s.last_tick, s.batch_id AS current_batch, s.next_tick,
    (SELECT event_seq FROM ticks ORDER BY tick_id DESC LIMIT 1) - t.event_seq AS pending_events FROM subs s LEFT JOIN ticks t ON t.tick_id = s.last_tick""",
    uses="subs ticks",
)
def consumer_info_q(spark, folder):
    return monitor.consumer_info(fx.subscriptions(spark, folder), fx.queue_ticks(spark, folder), NOW)


@query(
    "batch_info",
    f"""SELECT s.batch_id, s.queue, s.consumer, a.tick_time AS batch_start, b.tick_time AS batch_end, a.tick_id AS prev_tick_id, b.tick_id, {LAG.format(t='b.tick_time')} AS lag_us,
    a.event_seq AS seq_start, b.event_seq AS seq_end FROM subs s JOIN ticks a ON a.tick_id = s.last_tick JOIN ticks b ON b.tick_id = s.next_tick WHERE s.batch_id IS NOT NULL""",
    uses="subs ticks",
)
def batch_info_q(spark, folder):
    return monitor.batch_info(fx.subscriptions(spark, folder), fx.queue_ticks(spark, folder), NOW)


@query(
    "overview",
    "SELECT 'queues' AS component, count(*) AS n FROM supplier UNION ALL SELECT 'subscriptions', count(*) FROM customer",
)
def overview_q(spark, folder):
    return monitor.overview(fx.queue_configs(spark, folder), fx.subscriptions(spark, folder))


fx.CTE["beats"] = (
    [],
    """SELECT 'w' || (user_id % 50) AS worker, event_id AS seq, epoch_us(ts) AS at_us,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'starting' WHEN 'view' THEN 'standby' WHEN 'click' THEN 'activity' ELSE 'active' END AS beat FROM events""",
)
fx.CTE["folded"] = (
    ["beats"],
    """SELECT *, coalesce(phase IN ('active', 'standby'), false) AS contact FROM (SELECT worker, seq, at_us, beat,
      last_value(CASE WHEN beat <> 'activity' THEN beat END IGNORE NULLS) OVER (PARTITION BY worker ORDER BY seq) AS phase FROM beats)""",
)
fx.CTE["status"] = (
    ["folded"],
    """SELECT worker, CASE WHEN p IN ('active', 'standby') AND epoch_us(TIMESTAMP '2024-01-31') - last_us > 21600000000 THEN 'stalled' ELSE p END AS phase, last_us
    FROM (SELECT worker, arg_max(phase, seq) AS p, max(at_us) FILTER (WHERE contact) AS last_us FROM folded GROUP BY 1)""",
)


def beats(spark, folder):
    names = {"error": "failed", "signup": "starting", "view": "standby", "click": "activity"}
    beat = F.lit("active")
    for kind, phase in names.items():
        beat = F.when(F.col("event_type") == kind, F.lit(phase)).otherwise(beat)
    return fx.table(spark, folder, "events").select(
        F.concat(F.lit("w"), (F.col("user_id") % 50).cast("string")).alias("worker"), F.col("event_id").alias("seq"), F.unix_micros("ts").alias("at_us"), beat.alias("beat")
    )


@query("activity_fold", "SELECT worker, seq, at_us, beat, phase, contact FROM folded", uses="folded")
def activity_fold_q(spark, folder):
    return monitor.activity_fold(beats(spark, folder), 4096)


@query("worker_status", "SELECT worker, phase, last_us FROM status", uses="status")
def worker_status_q(spark, folder):
    return monitor.worker_status(beats(spark, folder), "2024-01-31 00:00:00", 21_600, 4096)


@query(
    "readiness",
    "SELECT count(*) AS workers, count(*) > 0 AND bool_and(phase IN ('active', 'standby')) AS ready FROM status",
    uses="status",
)
def readiness_q(spark, folder):
    return monitor.readiness(monitor.worker_status(beats(spark, folder), "2024-01-31 00:00:00", 21_600, 4096))


fx.CTE["states"] = (
    [],
    """SELECT 's' || (user_id % 20) AS stream, event_id AS seq, epoch_us(ts) AS at_us, CASE WHEN event_id // 100 % 7 IN (2, 3) THEN 'failed' WHEN event_id // 100 % 7 = 4 THEN 'conflict'
      WHEN event_type = 'view' THEN 'standby' ELSE 'active' END AS phase FROM events""",
)
fx.CTE["islands"] = (
    ["states"],
    """SELECT *, sum(CASE WHEN chg THEN 1 ELSE 0 END) OVER (PARTITION BY stream ORDER BY seq) AS island FROM
      (SELECT *, lag(phase) OVER w AS prev, phase IS DISTINCT FROM lag(phase) OVER w AS chg FROM states WINDOW w AS (PARTITION BY stream ORDER BY seq))""",
)


def states(spark, folder):
    part = F.expr("event_id div 100") % 7
    phase = (
        F.when(part.isin(2, 3), F.lit("failed"))
        .when(part == 4, F.lit("conflict"))
        .when(F.col("event_type") == "view", F.lit("standby"))
        .otherwise(F.lit("active"))
    )
    return fx.table(spark, folder, "events").select(
        F.concat(F.lit("s"), (F.col("user_id") % 20).cast("string")).alias("stream"), F.col("event_id").alias("seq"), F.unix_micros("ts").alias("at_us"), phase.alias("phase")
    )


@query(
    "transitions",
    """WITH i AS (SELECT stream, island, min(at_us) AS started, count(*) AS n FROM islands GROUP BY 1, 2)
    SELECT a.stream, a.seq, a.at_us, a.prev AS previous, a.phase, CASE WHEN a.prev IN ('failed', 'conflict') AND a.phase IN ('active', 'standby') THEN a.at_us - i.started END AS outage_us,
    CASE WHEN a.prev IN ('failed', 'conflict') AND a.phase IN ('active', 'standby') THEN i.n END AS failures FROM islands a LEFT JOIN i ON i.stream = a.stream AND i.island = a.island - 1 WHERE a.chg""",
    uses="islands",
)
def transitions_q(spark, folder):
    return monitor.transitions(states(spark, folder), 4096)


@query(
    "repeat_summary",
    """WITH RECURSIVE r AS (SELECT stream, island, seq, at_us, phase, row_number() OVER (PARTITION BY stream, island ORDER BY seq) AS n FROM islands WHERE phase IN ('failed', 'conflict')),
    f AS (SELECT *, at_us AS reported, false AS hit FROM r WHERE n = 1
      UNION ALL SELECT r.stream, r.island, r.seq, r.at_us, r.phase, r.n, CASE WHEN r.at_us - f.reported >= 3600000000 THEN r.at_us ELSE f.reported END, r.at_us - f.reported >= 3600000000
      FROM f JOIN r ON r.stream = f.stream AND r.island = f.island AND r.n = f.n + 1)
    SELECT stream, seq, at_us, phase, n AS failures FROM f WHERE hit""",
    uses="islands",
)
def repeat_summary_q(spark, folder):
    return monitor.repeat_summary(states(spark, folder), 3600, 4096)


@query(
    "snapshot_lag",
    f"""SELECT s.queue, s.consumer, (SELECT max(tick_id) FROM ticks) - s.last_tick AS pending_ticks, {LAG.format(t='t.tick_time')} AS consumer_lag_us,
    {LAG.format(t='(SELECT max(tick_time) FROM ticks)')} AS ticker_lag_us FROM subs s JOIN ticks t ON t.tick_id = s.last_tick""",
    uses="subs ticks",
)
def snapshot_lag_q(spark, folder):
    return monitor.snapshot_lag(fx.subscriptions(spark, folder), fx.queue_ticks(spark, folder), NOW)
