"""Retries and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkcdc.operators.ordered import dense_positions

# Defaults of the retry rules.
DEFAULT_MAX_RETRIES = 5
DEFAULT_REASON = "max retries exceeded"
DEFAULT_RETRY_SECONDS = 60
DUE_PER_CALL = 10
INSPECT_LIMIT = 100


def nack_route(batch: DataFrame, failures: DataFrame, queues: DataFrame) -> DataFrame:
    """Where each refused event goes, judged on the stored event, not on the caller's copy.

    ``failures(ev_id[, reason])``, ``queues(queue, max_retries)``. ``route`` is ``retry``, ``dead`` or
    ``unknown`` for ids that are not in the batch.
    """
    if "reason" not in failures.columns:
        failures = failures.withColumn("reason", F.lit(None).cast("string"))
    asked = failures.select("ev_id", "reason")
    found = asked.join(batch.drop("reason").withColumn("_found", F.lit(True)), "ev_id", "left")
    found = found.join(queues.select("queue", "max_retries"), "queue", "left")
    limit = F.coalesce(F.col("max_retries"), F.lit(DEFAULT_MAX_RETRIES))
    spent = F.coalesce(F.col("ev_retry"), F.lit(0)) >= limit
    route = F.when(F.col("_found").isNull(), F.lit("unknown")).when(spent, F.lit("dead")).otherwise(F.lit("retry"))
    reason = F.when(route == "dead", F.coalesce(F.col("reason"), F.lit(DEFAULT_REASON)))
    return found.select(*batch.columns, route.alias("route"), reason.alias("dl_reason"))


def require_known(routed: DataFrame) -> DataFrame:
    """Fail the job when a refused id was not in its batch."""
    return routed.withColumn(
        "route",
        F.when(F.col("route") == "unknown", F.raise_error(F.lit("event not found in batch")).cast("string")).otherwise(F.col("route")),
    )


def event_retry(events: DataFrame, waiting: DataFrame, retry_after) -> DataFrame:
    """Rows to add to the retry table: one more try, owned by the subscriber, no transaction.
    Events already waiting for that subscriber add nothing. ``events`` carries ``sub_id``."""
    fresh = events.withColumn("ev_owner", F.col("sub_id")).dropDuplicates(["ev_owner", "ev_id"])
    fresh = fresh.join(waiting.select("ev_owner", "ev_id"), ["ev_owner", "ev_id"], "left_anti")
    return fresh.select(
        "queue",
        "ev_id",
        "ev_time",
        F.lit(None).cast("bigint").alias("ev_txid"),
        "ev_owner",
        (F.coalesce(F.col("ev_retry"), F.lit(0)) + 1).cast("int").alias("ev_retry"),
        "ev_type",
        "ev_data",
        retry_after.alias("retry_after"),
    )


def batch_retry(window: DataFrame, waiting: DataFrame, now, seconds: int = DEFAULT_RETRY_SECONDS) -> DataFrame:
    """Every event of the given windows to the retry table, minus those waiting already."""
    at = F.timestamp_micros(F.unix_micros(F.lit(now).cast("timestamp")) + seconds * 1_000_000)
    return event_retry(window, waiting, at)


def dead_letter(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Dead letters after adding ``incoming``: the first per (queue, consumer, event) stays."""
    key = ["queue", "consumer", "ev_id"]
    # min over a struct keeps the earliest letter with map-side combining, no per-key sort.
    rest = [c for c in incoming.columns if c not in key and c != "dl_id"]
    first = incoming.groupBy(*key).agg(F.min(F.struct("dl_id", *rest)).alias("_f")).select(*key, "_f.*")
    new = first.join(existing.select(*key), key, "left_anti")
    return existing.select(*incoming.columns).unionByName(new.select(*incoming.columns))


def due_retries(waiting: DataFrame, now, limit: int = DUE_PER_CALL) -> tuple[DataFrame, DataFrame]:
    """The oldest due rows, ``limit`` per call over all queues, and what stays behind."""
    at = F.lit(now).cast("timestamp")
    due = waiting.where(F.col("retry_after") <= at).orderBy("retry_after", "ev_id", "ev_owner").limit(limit)
    left = waiting.join(due.select("ev_owner", "ev_id"), ["ev_owner", "ev_id"], "left_anti")
    return due.drop("retry_after"), left


def dlq_inspect(letters: DataFrame, queue: str, limit: int = INSPECT_LIMIT) -> DataFrame:
    """Newest dead letters of a queue."""
    return letters.where(F.col("queue") == queue).orderBy(F.col("dl_time").desc(), F.col("dl_id").desc()).limit(limit)


def dlq_replay(letters: DataFrame, queues: DataFrame, last_id, width: int = 65536) -> tuple[DataFrame, DataFrame]:
    """Append dead letters again as new events: new id, no owner, no retry count.

    Letters of a disabled queue cannot be appended; they stay. Returns the new events and, per
    queue, how many went through, how many failed and the first error.
    """
    state = queues.select("queue", "disabled")
    checked = letters.join(state, "queue", "left").withColumn(
        "_error",
        F.when(F.col("disabled").isNull(), F.lit("no such queue")).when(F.col("disabled"), F.lit("queue disabled")),
    )
    good = checked.where(F.col("_error").isNull())
    placed = dense_positions(good, [], "dl_id", "_pos", width)
    replayed = placed.select(
        "queue",
        "dl_id",
        (last_id + F.col("_pos")).alias("ev_id"),
        F.lit(None).cast("int").alias("ev_owner"),
        F.lit(None).cast("int").alias("ev_retry"),
        "ev_type",
        "ev_data",
    )
    message = F.concat(F.lit("dl_id="), F.col("dl_id").cast("string"), F.lit(": "), F.col("_error"))
    summary = checked.groupBy("queue").agg(
        F.count_if(F.col("_error").isNull()).alias("replayed"),
        F.count_if(F.col("_error").isNotNull()).alias("failed"),
        F.min_by(F.when(F.col("_error").isNotNull(), message), F.when(F.col("_error").isNotNull(), F.col("dl_id"))).alias("first_error"),
    )
    return replayed, summary


def dlq_purge(letters: DataFrame, now, older_than_days: int = 30) -> tuple[DataFrame, DataFrame]:
    """Letters that stay, and how many went per queue."""
    old = F.col("dl_time") < F.timestamp_micros(F.unix_micros(F.lit(now).cast("timestamp")) - older_than_days * 86_400_000_000)
    return letters.where(~old), letters.groupBy("queue").agg(F.count_if(old).alias("purged"))


def release_batch(window: DataFrame, queues: DataFrame, now, seconds: int = DEFAULT_RETRY_SECONDS) -> DataFrame:
    """Give up open windows: each event is retried later or, when its tries are spent, dead."""
    limit = F.coalesce(F.col("max_retries"), F.lit(DEFAULT_MAX_RETRIES))
    spent = F.coalesce(F.col("ev_retry"), F.lit(0)) >= limit
    at = F.timestamp_micros(F.unix_micros(F.lit(now).cast("timestamp")) + seconds * 1_000_000)
    return window.join(queues.select("queue", "max_retries"), "queue", "left").select(
        "queue",
        "sub_id",
        "ev_id",
        F.when(spent, F.lit("dead")).otherwise(F.lit("retry")).alias("route"),
        F.when(~spent, (F.coalesce(F.col("ev_retry"), F.lit(0)) + 1).cast("int")).alias("ev_retry"),
        F.when(~spent, at).alias("retry_after"),
    )


def stale_leases(subscriptions: DataFrame, now, dead_seconds: int) -> DataFrame:
    """Per queue the member to take over: it holds a batch and has been silent too long; the
    longest silent first, then the lowest id."""
    cutoff = F.timestamp_micros(F.unix_micros(F.lit(now).cast("timestamp")) - dead_seconds * 1_000_000)
    stale = subscriptions.where(F.col("batch_id").isNotNull() & (F.col("active") < cutoff))
    return stale.groupBy("queue").agg(
        F.min(F.struct("active", "sub_id", "batch_id", "last_tick", "next_tick")).alias("_v"), F.count("*").alias("stale")
    ).select("queue", "stale", "_v.sub_id", "_v.batch_id", "_v.last_tick", "_v.next_tick")
