"""Queue, consumer and worker state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcdc.operators.ordered import running
from sparkcdc.operators.segments import Measure, greedy_cuts

# How many tick ids the event rate looks back, phases, summary cadence.
RATE_TICKS = 20
HEALTHY = ("active", "standby")
DEGRADED = ("failed", "conflict")
SUMMARY_SECONDS = 60


def _now_us(now) -> Column:
    return F.unix_micros(F.lit(now).cast("timestamp"))


def queue_info(queues: DataFrame, ticks: DataFrame, now) -> DataFrame:
    """Per queue: ticker lag, events per second, events after the last tick, last tick.

    ``queues(queue, last_seq)``. The rate spans from the oldest tick whose id is at least the newest
    minus 20, so gaps in ids shorten it; it is null when no time passed.
    """
    newest = ticks.groupBy("queue").agg(F.max(F.struct("tick_id", "tick_time", "event_seq")).alias("_new"))
    recent = ticks.join(newest, "queue").where(F.col("tick_id") >= F.col("_new")["tick_id"] - RATE_TICKS)
    spans = recent.groupBy("queue").agg(F.max("_new").alias("_new"), F.min(F.struct("tick_id", "tick_time", "event_seq")).alias("_old"))
    span = F.unix_micros(F.col("_new")["tick_time"]) - F.unix_micros(F.col("_old")["tick_time"])
    rate = F.when(span > 0, (F.col("_new")["event_seq"] - F.col("_old")["event_seq"]) / (span / 1_000_000))
    return queues.join(spans, "queue", "left").select(
        "queue",
        (_now_us(now) - F.unix_micros(F.col("_new")["tick_time"])).alias("ticker_lag_us"),
        rate.alias("ev_per_sec"),
        (F.col("last_seq") - F.col("_new")["event_seq"]).alias("ev_new"),
        F.col("_new")["tick_id"].alias("last_tick_id"),
    )


def consumer_info(subscriptions: DataFrame, ticks: DataFrame, now) -> DataFrame:
    """Per subscription: lag and last contact, cursor, open batch, and pending events, which is a
    difference of sequence marks and so an estimate."""
    newest = ticks.groupBy("queue").agg(F.max_by("event_seq", "tick_id").alias("_top_seq"))
    at = ticks.select("queue", F.col("tick_id").alias("last_tick"), F.col("tick_time").alias("_t"), F.col("event_seq").alias("_s"))
    joined = subscriptions.join(newest, "queue", "left").join(at, ["queue", "last_tick"], "left")
    return joined.select(
        "queue",
        "consumer",
        (_now_us(now) - F.unix_micros("_t")).alias("lag_us"),
        (_now_us(now) - F.unix_micros("active")).alias("last_seen_us"),
        "last_tick",
        F.col("batch_id").alias("current_batch"),
        "next_tick",
        (F.col("_top_seq") - F.col("_s")).alias("pending_events"),
    )


def batch_info(subscriptions: DataFrame, ticks: DataFrame, now) -> DataFrame:
    """Time and sequence range of every open batch."""

    def tick(name: str, prefix: str) -> DataFrame:
        return ticks.select(
            "queue", F.col("tick_id").alias(name), F.col("tick_time").alias(prefix + "_time"), F.col("event_seq").alias(prefix + "_seq")
        )

    held = subscriptions.where(F.col("batch_id").isNotNull())
    joined = held.join(tick("last_tick", "_a"), ["queue", "last_tick"]).join(tick("next_tick", "_b"), ["queue", "next_tick"])
    return joined.select(
        "batch_id",
        "queue",
        "consumer",
        F.col("_a_time").alias("batch_start"),
        F.col("_b_time").alias("batch_end"),
        F.col("last_tick").alias("prev_tick_id"),
        F.col("next_tick").alias("tick_id"),
        (_now_us(now) - F.unix_micros("_b_time")).alias("lag_us"),
        F.col("_a_seq").alias("seq_start"),
        F.col("_b_seq").alias("seq_end"),
    )


def overview(queues: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """How many queues are configured and how many subscriptions exist."""
    first = queues.agg(F.lit("queues").alias("component"), F.count("*").alias("n"))
    return first.unionByName(subscriptions.agg(F.lit("subscriptions").alias("component"), F.count("*").alias("n")))


def activity_fold(beats: DataFrame, width_us: int) -> DataFrame:
    """Phase in force at each beat. ``beats(worker, seq, at_us, beat)``: a beat is a phase, or ``activity``,
    which extends an active or standby worker and never revives another. Adds ``phase`` and
    ``contact``, true where the beat renews the last contact."""
    marked = running(
        beats, ["worker"], "seq", {"phase": ("last", F.when(F.col("beat") != "activity", F.col("beat")))}, width_us, inclusive=True
    )
    return marked.withColumn("contact", F.coalesce(F.col("phase").isin(*HEALTHY), F.lit(False)))


def worker_status(beats: DataFrame, now, deadline_seconds: int, width_us: int) -> DataFrame:
    """Last phase per worker; an active or standby one silent beyond its deadline is ``stalled``."""
    folded = activity_fold(beats, width_us)
    last = folded.groupBy("worker").agg(
        F.max_by("phase", "seq").alias("_phase"), F.max(F.when(F.col("contact"), F.col("at_us"))).alias("last_us")
    )
    late = F.col("_phase").isin(*HEALTHY) & (_now_us(now) - F.col("last_us") > deadline_seconds * 1_000_000)
    return last.select("worker", F.when(late, F.lit("stalled")).otherwise(F.col("_phase")).alias("phase"), "last_us")


def readiness(status: DataFrame, stopping: bool = False) -> DataFrame:
    """Ready: at least one worker, every one active or standby, and not stopping."""
    return status.agg(
        F.count("*").alias("workers"),
        (F.lit(not stopping) & (F.count("*") > 0) & F.coalesce(F.bool_and(F.col("phase").isin(*HEALTHY)), F.lit(False))).alias("ready"),
    )


def _islands(log: DataFrame, width: int) -> DataFrame:
    """Rows with their previous phase, whether they change it, and their position in the stream."""
    seen = running(log, ["stream"], "seq", {"_prev": ("last", F.col("phase")), "_n": ("count", F.lit(1))}, width)
    return seen.withColumn("_changes", ~F.col("phase").eqNullSafe(F.col("_prev")))


def transitions(log: DataFrame, width: int = 1 << 16) -> DataFrame:
    """One row per change of phase of ``log(stream, seq, at_us, phase)``. Where a stream recovers, with
    the length of the outage that ends and the failures it counted."""
    changes = _islands(log, width).where("_changes")
    before = running(
        changes, ["stream"], "seq", {"_start_us": ("last", F.col("at_us")), "_start_n": ("last", F.col("_n"))}, width
    )
    recovered = F.col("_prev").isin(*DEGRADED) & F.col("phase").isin(*HEALTHY)
    return before.select(
        "stream",
        "seq",
        "at_us",
        F.col("_prev").alias("previous"),
        "phase",
        F.when(recovered, F.col("at_us") - F.col("_start_us")).alias("outage_us"),
        F.when(recovered, F.col("_n") - F.col("_start_n")).alias("failures"),
    )


def repeat_summary(log: DataFrame, every_seconds: int = SUMMARY_SECONDS, width: int = 1 << 16) -> DataFrame:
    """Summaries of a failure that goes on: the first row of an outage counts as reported, then the
    first row at least ``every_seconds`` after the last report, and so on, with the failures so far."""
    numbered = running(
        _islands(log, width), ["stream"], "seq",
        {"island": ("sum", F.col("_changes").cast("bigint")), "_since": ("last", F.when(F.col("_changes"), F.col("_n")))},
        width, inclusive=True,
    )
    failing = numbered.where(F.col("phase").isin(*DEGRADED)).select(
        "stream", "island", "seq", "at_us", "phase", (F.col("_n") - F.col("_since") + 1).alias("failures"), "_changes"
    )
    cut = greedy_cuts(failing, ["stream", "island"], "seq", [Measure("at_us", every_seconds * 1_000_000 - 1, running=False)], "_report")
    return cut.where(F.col("_report_start") & ~F.col("_changes")).select("stream", "seq", "at_us", "phase", "failures")


def snapshot_lag(subscriptions: DataFrame, ticks: DataFrame, now) -> DataFrame:
    """Per subscription: tick ids between its cursor and the newest tick, its lag, the ticker's lag."""
    newest = ticks.groupBy("queue").agg(F.max("tick_id").alias("_top"), F.max("tick_time").alias("_at"))
    at = ticks.select("queue", F.col("tick_id").alias("last_tick"), F.col("tick_time").alias("_t"))
    joined = subscriptions.join(at, ["queue", "last_tick"]).join(newest, "queue")
    return joined.select(
        "queue",
        "consumer",
        (F.col("_top") - F.col("last_tick")).alias("pending_ticks"),
        (_now_us(now) - F.unix_micros("_t")).alias("consumer_lag_us"),
        (_now_us(now) - F.unix_micros("_at")).alias("ticker_lag_us"),
    )
