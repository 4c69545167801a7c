"""Derived inputs over the generic test tables, each as a DataFrame and as DuckDB SQL.

Every frame grows with the table it is derived from. The SQL text of a frame is a list of
common table expressions; ``with_sql`` glues the needed ones in front of a body.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TXID_BASE = 1000
#: Ticks that one task makes from one row.
TICK_BLOCK = 4096
TICK_SPAN = 50
QUEUES = ["q0", "q1", "q2"]

# Table plans by session and place, so that a query naming a table twice reads its footers once.
_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; zone-less timestamps are read as UTC instants."""
    key = (spark.sparkContext.applicationId, id(spark), folder, name)
    if key not in _TABLES:
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        for field in df.schema.fields:
            if field.dataType.typeName() == "timestamp_ntz":
                df = df.withColumn(field.name, F.col(field.name).cast("timestamp"))
        _TABLES[key] = df
    return _TABLES[key]


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Event log rows."""
    owned = F.col("event_id") % 97 == 0
    return table(spark, folder, "events").select(
        F.concat(F.lit("q"), (F.col("user_id") % 3).cast("string")).alias("queue"),
        (F.col("event_id") + 1).alias("ev_id"),
        F.col("ts").alias("ev_time"),
        F.expr(f"{TXID_BASE} + event_id div 3").alias("ev_txid"),
        F.when(owned, F.col("user_id").cast("int")).alias("ev_owner"),
        F.when(owned, (F.col("event_id") % 7).cast("int")).alias("ev_retry"),
        F.col("event_type").alias("ev_type"),
        F.col("props").alias("ev_data"),
        F.lit("public.events").alias("ev_extra1"),
        F.lit(None).cast("string").alias("ev_extra2"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with their end position; every 23rd ends late, every 29th rolls back."""
    return (
        events(spark, folder)
        .select(F.col("ev_txid").alias("txid"))
        .distinct()
        .select(
            "txid",
            F.col("txid").alias("begin_pos"),
            (F.col("txid") + 1 + F.when(F.col("txid") % 23 == 0, F.lit(60)).otherwise(F.col("txid") % 5)).alias("end_pos"),
            (F.col("txid") % 29 != 0).alias("committed"),
        )
    )


def committed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of transactions that did not roll back."""
    return events(spark, folder).where(F.col("ev_txid") % 29 != 0)


def tick_moments(spark: SparkSession, folder: str) -> DataFrame:
    """One tick per 50 transaction ids, running past the end so that late work is seen."""
    top = events(spark, folder).agg(
        F.max("ev_txid").alias("top"), F.max("ev_id").alias("last_id")
    )
    # Blocks of ticks leave the one row first and are dealt; their ticks are made where the blocks are.
    last = f"(top - {TXID_BASE} + 1 + 149) div {TICK_SPAN}"
    blocks = top.select("last_id", F.expr(last).alias("end"), F.explode(F.expr(f"sequence(0L, ({last} - 1) div {TICK_BLOCK})")).alias("block"))
    inside = F.expr(f"sequence(block * {TICK_BLOCK} + 1, least((block + 1) * {TICK_BLOCK}, end))")
    ids = blocks.repartition("block").select(F.explode(inside).alias("tick_id"), "last_id")
    return ids.select(
        "tick_id",
        (F.lit(TXID_BASE) + TICK_SPAN * F.col("tick_id")).alias("pos"),
        F.expr("timestamp_micros(1704067200000000L + tick_id * 60000000L)").alias("tick_time"),
        F.least(F.col("tick_id") * 3 * TICK_SPAN, F.col("last_id")).alias("event_seq"),
    )


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks with their snapshot."""
    moments = tick_moments(spark, folder)
    running = (
        transactions(spark, folder)
        .select(
            "txid",
            F.explode(
                F.expr(
                    f"filter(sequence((txid - {TXID_BASE}) div {TICK_SPAN} + 1, (end_pos - {TXID_BASE}) div {TICK_SPAN} + 1),"
                    f" t -> {TXID_BASE} + {TICK_SPAN} * t > txid and {TXID_BASE} + {TICK_SPAN} * t < end_pos)"
                )
            ).alias("tick_id"),
        )
        .groupBy("tick_id")
        .agg(F.sort_array(F.collect_list("txid")).alias("xip"))
    )
    return moments.join(running, "tick_id", "left").select(
        "tick_id",
        "tick_time",
        F.coalesce(F.col("xip")[0], F.col("pos")).alias("xmin"),
        F.col("pos").alias("xmax"),
        F.coalesce(F.col("xip"), F.array().cast("array<bigint>")).alias("xip"),
        "event_seq",
    )


def queue_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """The shared ticks, once per queue."""
    return ticks(spark, folder).select(F.explode(F.array(*[F.lit(q) for q in QUEUES])).alias("queue"), "*")


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """One subscription per customer, spread over the tick log; every fourth holds an open batch."""
    newest = ticks(spark, folder).agg(F.max("tick_id")).scalar()
    key = F.col("c_custkey")
    last = F.lit(1) + F.pmod(key, newest - 1)
    is_open = key % 4 == 0
    return table(spark, folder, "customer").select(
        F.concat(F.lit("q"), (key % 3).cast("string")).alias("queue"),
        key.cast("int").alias("sub_id"),
        F.concat(F.lit("c"), key.cast("string")).alias("consumer"),
        last.alias("last_tick"),
        F.when(is_open, last + 1).alias("next_tick"),
        F.when(is_open, key + 1).alias("batch_id"),
        F.expr("timestamp_micros(1704067200000000L + c_custkey * 60000000L)").alias("active"),
    )


def queue_configs(spark: SparkSession, folder: str) -> DataFrame:
    """One queue per supplier with its settings and rotation marks."""
    k = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("s"), k.cast("string")).alias("queue"),
        (k % 50 + 1).alias("max_count"),
        ((k % 5 + 1) * 600).alias("max_lag_s"),
        ((k % 4 + 1) * 7200).alias("idle_s"),
        ((k % 6) * 3600).alias("rotation_s"),
        (k % 3).alias("cur_segment"),
        F.lit(3).cast("bigint").alias("n_segments"),
        (F.lit(TXID_BASE) + k * 7 % 1500).alias("step1"),
        F.when(k % 7 != 0, F.lit(TXID_BASE) + k * 7 % 1500 + 1).alias("step2"),
        F.expr("timestamp_micros(1704067200000000L + s_suppkey * 600000000L)").alias("switch_time"),
        (k % 11 == 0).alias("paused"),
        (k % 5 == 0).alias("external"),
        F.when(k % 3 != 0, (k % 6).cast("int")).alias("max_retries"),
    )


def retries(spark: SparkSession, folder: str) -> DataFrame:
    """Events waiting to be delivered again."""
    return events(spark, folder).where(F.col("ev_owner").isNotNull()).withColumn(
        "retry_after", F.col("ev_time") + F.expr("interval 1 hour")
    )


def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Events given up after five retries."""
    return (
        events(spark, folder)
        .where(F.col("ev_retry") >= 5)
        .select(
            (F.col("ev_id") - 1).alias("dl_id"),
            F.col("ev_time").alias("dl_time"),
            F.concat(F.lit("c"), F.col("ev_owner").cast("string")).alias("consumer"),
            "*",
        )
    )


CTE: dict[str, tuple[list[str], str]] = {
    "ev": (
        [],
        """SELECT 'q' || (user_id % 3) AS queue, event_id + 1 AS ev_id, ts AS ev_time, 1000 + event_id // 3 AS ev_txid,
        CASE WHEN event_id % 97 = 0 THEN CAST(user_id AS INTEGER) END AS ev_owner,
        CASE WHEN event_id % 97 = 0 THEN CAST(event_id % 7 AS INTEGER) END AS ev_retry,
        event_type AS ev_type, props AS ev_data, 'public.events' AS ev_extra1, CAST(NULL AS VARCHAR) AS ev_extra2
        FROM events""",
    ),
    "evc": (["ev"], "SELECT * FROM ev WHERE ev_txid % 29 <> 0"),
    "tx": (
        ["ev"],
        """SELECT DISTINCT ev_txid AS txid, ev_txid AS begin_pos,
        ev_txid + 1 + CASE WHEN ev_txid % 23 = 0 THEN 60 ELSE ev_txid % 5 END AS end_pos, ev_txid % 29 <> 0 AS committed
        FROM ev""",
    ),
    "moments": (
        ["ev"],
        """SELECT tick_id, 1000 + 50 * tick_id AS pos, TIMESTAMP '2024-01-01' + to_minutes(CAST(tick_id AS INTEGER)) AS tick_time,
        (SELECT max(ev_id) FROM ev WHERE ev_txid < 1000 + 50 * tick_id) AS event_seq
        FROM (SELECT unnest(generate_series(1, (SELECT (max(ev_txid) - 1000 + 1 + 149) // 50 FROM ev))) AS tick_id)""",
    ),
    "ticks": (
        ["tx", "moments"],
        """SELECT m.tick_id, m.tick_time, coalesce(min(x.txid), m.pos) AS xmin, m.pos AS xmax,
        coalesce(list(x.txid ORDER BY x.txid) FILTER (WHERE x.txid IS NOT NULL), []) AS xip, m.event_seq
        FROM moments m LEFT JOIN tx x ON x.txid < m.pos AND x.end_pos > m.pos
        GROUP BY m.tick_id, m.tick_time, m.pos, m.event_seq""",
    ),
    "qticks": (
        ["ticks"],
        "SELECT q.queue, t.* FROM ticks t, (SELECT unnest(['q0','q1','q2']) AS queue) q",
    ),
    "subs": (
        ["moments"],
        """SELECT 'q' || (c_custkey % 3) AS queue, CAST(c_custkey AS INTEGER) AS sub_id, 'c' || c_custkey AS consumer,
        1 + c_custkey % (newest - 1) AS last_tick,
        CASE WHEN c_custkey % 4 = 0 THEN 2 + c_custkey % (newest - 1) END AS next_tick,
        CASE WHEN c_custkey % 4 = 0 THEN c_custkey + 1 END AS batch_id,
        TIMESTAMP '2024-01-01' + to_minutes(CAST(c_custkey AS INTEGER)) AS active
        FROM customer, (SELECT max(tick_id) AS newest FROM moments)""",
    ),
    "queues": (
        [],
        """SELECT 's' || s_suppkey AS queue, s_suppkey % 50 + 1 AS max_count, (s_suppkey % 5 + 1) * 600 AS max_lag_s,
        (s_suppkey % 4 + 1) * 7200 AS idle_s, (s_suppkey % 6) * 3600 AS rotation_s, s_suppkey % 3 AS cur_segment,
        CAST(3 AS BIGINT) AS n_segments, 1000 + s_suppkey * 7 % 1500 AS step1,
        CASE WHEN s_suppkey % 7 <> 0 THEN 1000 + s_suppkey * 7 % 1500 + 1 END AS step2,
        TIMESTAMP '2024-01-01' + to_minutes(CAST(s_suppkey * 10 AS INTEGER)) AS switch_time,
        s_suppkey % 11 = 0 AS paused, s_suppkey % 5 = 0 AS external,
        CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey % 6 AS INTEGER) END AS max_retries
        FROM supplier""",
    ),
    "retry": (["ev"], "SELECT *, ev_time + INTERVAL 1 HOUR AS retry_after FROM ev WHERE ev_owner IS NOT NULL"),
    "dead": (
        ["ev"],
        "SELECT ev_id - 1 AS dl_id, ev_time AS dl_time, 'c' || ev_owner AS consumer, * FROM ev WHERE ev_retry >= 5",
    ),
}


def with_sql(names: str, body: str) -> str:
    """``body`` with the named expressions, and those they need, in front."""
    done: list[str] = []

    def need(name: str) -> None:
        if name in done:
            return
        for other in CTE[name][0]:
            need(other)
        done.append(name)

    for name in names.split():
        need(name)
    if not done:
        return body
    heads = ",\n".join(f"{name} AS ({CTE[name][1]})" for name in done)
    tail = body.strip()
    if tail.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads},\n{tail[15:]}"
    if tail.startswith("WITH "):
        return f"WITH {heads},\n{tail[5:]}"
    return f"WITH {heads}\n{tail}"
