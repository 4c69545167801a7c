"""The event log: appending with dense ids, segments, rotation, fact lookup, record ingest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcdc.operators.ordered import asof_lookup, range_running, running

EVENT_SCHEMA = (
    "queue string, segment int, ev_id bigint, ev_time timestamp, ev_txid bigint, ev_owner int, ev_retry int, ev_type string,"
    " ev_data string, ev_extra1 string, ev_extra2 string, ev_extra3 string, ev_extra4 string"
)


def append_events(df: DataFrame, order: str, ties: Sequence[str], last_id: Column, disabled: Column | None = None) -> DataFrame:
    """Give rows the next ids in order. Rows that bring an id keep it; type defaults to ``default``;
    a row for a disabled queue fails the append. Rows are dealt by ranges of order and ties, so a burst of any
    length is spread; a null order goes first."""
    given = F.col("ev_id") if "ev_id" in df.columns else F.lit(None).cast("bigint")
    rows = df.withColumn("_given", given)
    fresh = range_running(rows.where(F.col("_given").isNull()), [], [order, *ties], F.lit(1).cast("bigint"), "_pos")
    kept = rows.where(F.col("_given").isNotNull()).withColumn("_pos", F.lit(None).cast("bigint"))
    both = fresh.unionByName(kept) if "ev_id" in df.columns else fresh
    kind = F.coalesce(F.col("ev_type"), F.lit("default"))
    if disabled is not None:
        kind = F.when(disabled, F.raise_error(F.lit("insert into disabled queue")).cast("string")).otherwise(kind)
    others = [c for c in df.columns if c not in ("ev_id", "ev_type")]
    return both.select(F.coalesce(F.col("_given"), last_id + F.col("_pos")).alias("ev_id"), kind.alias("ev_type"), *others)


def append_batch(df: DataFrame, order: str, payload: str, last_id: Column, width: int) -> DataFrame:
    """Rows holding a payload array become events, ids following row order then array order.

    Only the array sizes are summed across rows; the elements are numbered where they are.
    Adds ``ids``, in input order. A null array is an error, an empty one gives no ids.
    """
    size = F.when(
        F.col(payload).isNull(), F.raise_error(F.lit("payload array must not be null")).cast("bigint")
    ).otherwise(F.size(payload).cast("bigint"))
    placed = running(df, [], order, {"_before": ("sum", size)}, width)
    numbered = F.transform(F.col(payload), lambda x, i: last_id + F.col("_before") + i.cast("bigint") + 1)
    return placed.select(*df.columns, numbered.alias("ids"))


def batch_rows(numbered: DataFrame, payload: str) -> DataFrame:
    """The events of ``append_batch``, one row each."""
    zipped = F.arrays_zip(F.col("ids").alias("ids"), F.col(payload).alias("data"))
    others = [c for c in numbered.columns if c not in ("ids", payload)]
    return numbered.select(*others, F.explode(zipped).alias("_e")).select(
        *others, F.col("_e")["ids"].alias("ev_id"), F.col("_e")["data"].alias("ev_data")
    )


def to_segment(events: DataFrame, rotations: DataFrame, by: Sequence[str] = (), width: int = 4096) -> DataFrame:
    """Adds ``segment``: the table that was current for the event's transaction.
    ``rotations(by, from_txid, segment)``."""
    return asof_lookup(events, rotations, by, "ev_txid", "from_txid", ["segment"], width, strict=False, backward=True)


def write_segments(events: DataFrame, path: str) -> None:
    """Append to the log, one directory per queue and segment, sorted so that row-group statistics
    on the transaction id prune a batch read."""
    events.sortWithinPartitions("ev_txid").write.mode("append").partitionBy("queue", "segment").parquet(path)


def read_events(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.schema(EVENT_SCHEMA).parquet(path)


def batch_segments(batches: DataFrame) -> DataFrame:
    """Segments a batch can touch. ``batches`` carries ``tx_min, tx_max, step1, step2, cur_segment,
    n_segments``: wholly before the last switch only the previous one, wholly after its second
    mark only the current one, else both."""
    before = F.col("tx_max") < F.col("step1")
    after = F.col("tx_min") > F.col("step2")
    previous = F.when(F.col("cur_segment") == 0, F.col("n_segments") - 1).otherwise(F.col("cur_segment") - 1)
    segments = (
        F.when(before, F.array(previous))
        .when(F.coalesce(after, F.lit(False)), F.array(F.col("cur_segment")))
        .otherwise(F.array(previous, F.col("cur_segment")))
    )
    return batches.select("*", F.explode(segments).alias("segment"))


def rotation_plan(queues: DataFrame, subscriptions: DataFrame, ticks: DataFrame, now, tick_by: Sequence[str] = ("queue",)) -> DataFrame:
    """Queues to rotate now with the segment to empty: the period is over, the second mark is set,
    and the slowest cursor is past it (or nobody reads)."""
    slowest = subscriptions.groupBy("queue").agg(F.min("last_tick").alias("tick_id"))
    marks = ticks.select(*tick_by, "tick_id", F.col("xmin").alias("_xmin"))
    clock = F.unix_micros(F.lit(now).cast("timestamp"))
    over = F.unix_micros("switch_time") + F.col("rotation_s") * 1_000_000 < clock
    due = queues.where(over & F.col("step2").isNotNull()).join(slowest, "queue", "left")
    due = due.join(marks, [*tick_by, "tick_id"], "left")
    free = F.col("tick_id").isNull() | (F.col("_xmin") > F.col("step2"))
    following = F.pmod(F.col("cur_segment") + 1, F.col("n_segments"))
    return due.where(free).select("queue", following.alias("drop_segment"), F.col("step2").alias("expire_below"))


def expired_ticks(ticks: DataFrame, plan: DataFrame, tick_by: Sequence[str] = ("queue",)) -> DataFrame:
    """Ticks whose batches lie wholly in the emptied segment."""
    if tick_by:
        joined = ticks.join(plan.select("queue", "expire_below"), list(tick_by))
    else:
        # A shared tick log keeps whatever the most cautious queue still needs.
        joined = ticks.withColumn("expire_below", plan.agg(F.min("expire_below")).scalar())
    return joined.where(F.col("xmin") < F.col("expire_below")).drop("expire_below")


def facts_for_jobs(jobs: DataFrame, facts: DataFrame) -> DataFrame:
    """Jobs with their immutable fact; ``problem`` names a missing fact or another delivery id."""
    renamed = facts.withColumnRenamed("delivery_id", "_fact_delivery").withColumn("_fact", F.lit(True))
    joined = jobs.join(renamed, "job_id", "left")
    problem = F.when(F.col("_fact").isNull(), F.lit("missing fact")).when(
        ~F.col("delivery_id").eqNullSafe(F.col("_fact_delivery")), F.lit("delivery id differs")
    )
    return joined.withColumn("problem", problem).drop("_fact", "_fact_delivery")


def require_facts(hydrated: DataFrame) -> DataFrame:
    """Fail the batch on the first job without its fact."""
    return hydrated.withColumn("job_id", F.when(F.col("problem").isNotNull(), F.raise_error("problem").cast("bigint")).otherwise(F.col("job_id")))


def ingest_records(df: DataFrame, text: str, element: str) -> DataFrame:
    """Rows holding one JSON array each become typed rows; ``element`` is the DDL of one entry."""
    parsed = F.from_json(F.col(text), f"array<struct<{element}>>")
    return df.select(F.inline(parsed))
