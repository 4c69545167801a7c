"""Ticks: closing batches, snapshots at a tick, checks of external ticks and queue settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcdc.operators.ordered import asof_lookup, running


def tick_snapshot(transactions: DataFrame, moments: DataFrame, width: int = 1024) -> DataFrame:
    """Snapshot ``(xmin, xmax, xip)`` at each moment.

    ``transactions(txid, begin_pos, end_pos)`` and ``moments(tick_id, pos)`` share one position
    axis. A transaction is running at a moment when ``begin_pos < pos < end_pos``. It is turned into
    the run of ticks it spans by two as-of lookups, so the work is the size of the answer and
    no range join is needed.
    """
    numbered = running(moments, [], "pos", {"_seq": ("count", F.lit(1))}, width * 1024, inclusive=True)
    spans = asof_lookup(transactions, numbered.select("pos", F.col("_seq").alias("_first")), [], "begin_pos", "pos", ["_first"], width)
    spans = asof_lookup(
        spans, numbered.select("pos", F.col("_seq").alias("_last")), [], "end_pos", "pos", ["_last"], width, backward=True
    )
    open_at = (
        spans.where(F.col("_last") >= F.col("_first"))
        .select("txid", F.explode(F.sequence("_first", "_last")).alias("_seq"))
        .groupBy("_seq")
        .agg(F.sort_array(F.collect_list("txid")).alias("xip"))
    )
    started = asof_lookup(
        transactions, numbered.select("pos", "_seq"), [], "begin_pos", "pos", ["_seq"], width
    ).groupBy("_seq").agg(F.max("txid").alias("_top"))
    tops = running(
        numbered.join(started, "_seq", "left"), [], "_seq", {"_upto": ("max", F.col("_top"))}, 65536, inclusive=True
    )
    return tops.join(open_at, "_seq", "left").select(
        *[c for c in moments.columns if c != "pos"],
        F.coalesce(F.col("xip")[0], F.col("_upto") + 1).alias("xmin"),
        (F.col("_upto") + 1).alias("xmax"),
        F.coalesce(F.col("xip"), F.array().cast("array<bigint>")).alias("xip"),
    )


def external_tick_check(ticks: DataFrame, queues: DataFrame, by: str = "queue", arrival: str = "arrival", width: int = 65536) -> DataFrame:
    """Report on a log of offered ticks: the queue must exist, be external and not paused, tick
    ids must rise strictly and event_seq must not fall.

    Each tick is held against every earlier usable offer. The writer stops at its first refusal,
    and up to the first row with a reason both readings are the same, so "no reason anywhere"
    means exactly that the whole log is acceptable.
    """
    known = ticks.join(queues.select(by, "external", "paused"), by, "left")
    usable = F.coalesce(F.col("external") & ~F.col("paused"), F.lit(False))
    marked = running(
        known,
        [by],
        arrival,
        {
            "_max_tick": ("max", F.when(usable, F.col("tick_id"))),
            "_max_seq": ("max", F.when(usable, F.col("event_seq"))),
        },
        width,
    )
    reason = (
        F.when(F.col("external").isNull(), F.lit("queue not found"))
        .when(F.col("paused"), F.lit("paused"))
        .when(~F.col("external"), F.lit("not external"))
        .when(F.col("tick_id") <= F.coalesce(F.col("_max_tick"), F.lit(0)), F.lit("tick id not rising"))
        .when(F.col("event_seq") < F.col("_max_seq"), F.lit("event seq falls"))
    )
    return marked.select(*ticks.columns, reason.alias("reason"))


def queue_config_check(settings: DataFrame) -> DataFrame:
    """One row per ``(queue, name, value)`` setting with a reason where it is refused; null value
    means "back to default" and passes. Intervals are given in seconds."""
    # Setting names and the least value each accepts (None: a flag).
    minimum = {
        "ticker_max_count": "positive",
        "ticker_max_lag": "positive",
        "ticker_idle_period": "positive",
        "rotation_period": "positive",
        "max_retries": "not negative",
        "ticker_paused": "flag",
        "external_ticker": "flag",
    }
    name, value = F.col("name"), F.col("value")
    number = value.try_cast("double")

    def named(kind: str) -> Column:
        return name.isin([n for n, k in minimum.items() if k == kind])

    reason = (
        F.when(F.col("queue").isNull() | name.isNull(), F.lit("null name"))
        .when(~name.isin(list(minimum)), F.lit("unknown setting"))
        .when(value.isNull(), F.lit(None).cast("string"))
        .when(named("flag"), F.when(value.try_cast("boolean").isNull(), F.lit("not a boolean")))
        .when(number.isNull(), F.lit("not a number"))
        .when(named("positive") & (number <= 0), F.lit("must be > 0"))
        .when(named("not negative") & (number < 0), F.lit("must be >= 0"))
    )
    return settings.withColumn("reason", reason)


def poll_counts(events: DataFrame, period_seconds: int, by: Sequence[str] = ("queue",)) -> DataFrame:
    """Events reduced to one row per poll: the highest id handed out up to each poll time."""
    step = period_seconds * 1_000_000
    at = (F.floor(F.unix_micros("ev_time") / step) + 1) * step
    grouped = events.groupBy(*by, at.alias("at_us")).agg(F.max("ev_id").alias("_top"))
    return running(grouped, by, "at_us", {"event_seq": ("max", F.col("_top"))}, step * 65536, inclusive=True).drop("_top")


def close_batches(polls: DataFrame, queues: DataFrame) -> DataFrame:
    """Which polls close a batch.

    ``polls(queue, at_us, event_seq[, forced])``, ``queues(queue, max_count, max_lag_us, idle_us,
    paused, external)``. A poll with new events ticks when there are ``max_count`` of them or the
    last tick is ``max_lag`` old. A poll without new events ticks unless the last tick is younger
    than half of max_lag, or younger than both twice the gap before it and the idle period. The
    first poll, and an idle poll after a single tick, always tick. A forced poll counts as a burst.

    The decision feeds back into the next one, so each queue is read in poll order. Only poll
    rows get here, never events: their number is set by the clock, and the pass keeps two ticks
    of state per queue while Arrow batches stream through it.
    """
    columns = ["queue", "at_us", "event_seq", "forced", "max_count", "max_lag_us", "idle_us"]
    if "forced" not in polls.columns:
        polls = polls.withColumn("forced", F.lit(False))
    usable = queues.where(~F.col("paused") & ~F.col("external")).select("queue", "max_count", "max_lag_us", "idle_us")
    ordered = polls.join(usable, "queue").select(*columns).repartition("queue").sortWithinPartitions("queue", "at_us")

    def scan(batches):
        import pandas as pd

        queue = None
        last_at = last_seq = gap = None
        number = 0
        for frame in batches:
            out = []
            for name, at, seq, forced, count, lag, idle in frame[columns].itertuples(index=False):
                if name != queue:
                    queue, last_at, last_seq, gap, number = name, None, None, None, 0
                if last_at is not None and not forced:
                    age = at - last_at
                    if seq > last_seq:
                        if seq - last_seq < count and age < lag:
                            continue
                    elif gap is not None and (age * 2 < lag or (age < gap * 2 and age < idle)):
                        continue
                gap = None if last_at is None else at - last_at
                number += 1
                last_at, last_seq = at, seq
                out.append((name, number, at, seq))
            yield pd.DataFrame(out, columns=["queue", "tick_id", "at_us", "event_seq"])

    return ordered.mapInPandas(scan, "queue string, tick_id bigint, at_us bigint, event_seq bigint")


def force_close(polls: DataFrame, queue: str, at_us: int) -> DataFrame:
    """Mark the first poll of ``queue`` at or after ``at_us`` so that it closes a batch."""
    target = polls.where((F.col("queue") == queue) & (F.col("at_us") >= at_us)).agg(F.min("at_us")).scalar()
    forced = F.col("forced") if "forced" in polls.columns else F.lit(False)
    return polls.withColumn("forced", forced | F.coalesce((F.col("queue") == queue) & (F.col("at_us") == target), F.lit(False)))
