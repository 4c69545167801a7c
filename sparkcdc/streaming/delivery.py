"""Closed batches as a stream, delivered in order, in chunks, behind a fence per chunk.

The stream is the tick log: a micro-batch is some new ticks, and each tick closes a batch that holds what its
snapshot sees and the one before did not, late commits included, possibly nothing. Per micro-batch:

1. The events of its batches are dealt by ranges of (tick, id), encoded and staged once, sorted.
2. Counts per range, tick and topic (a table the size of the ranges) give every record its offset and its
   chunk; no record is sorted or counted in one task.
3. Chunks are published in waves. A wave's rows are written first, its markers after them, and readers see marked
   chunks only, so nothing of a chunk that failed is visible. A replay takes offsets from the end that the
   micro-batch before recorded, gets the same records and offsets, and leaves marked chunks alone.
4. After the last chunk of a batch its boundary goes to every route, idle ones included, under the next offsets.
5. The new end is recorded, and the checkpoint moves: that is the acknowledgement of the source.

An event id may be null or repeated: ids that are equal are ordered by key and value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkcdc.functions.codecs import utf8
from sparkcdc.functions.text import json_quote_exact
from sparkcdc.operators import envelope
from sparkcdc.operators.batches import assign_batches, batch_events
from sparkcdc.operators.progress import due_batches
from sparkcdc.streaming.relay import sized

# Rows and bytes of a chunk unless told otherwise.
CHUNK_ROWS, CHUNK_BYTES = 1000, 4 << 20
#: Names of the boundary field: managed delivery may repeat older boundaries, so its consumers must not take them for the others.
PROGRESS = {"fenced": "progress", "managed": "invalidation_progress"}
MAX_TOPICS = envelope.MAX_ROUTES

RECORD = "topic string, offset bigint, batch_tick bigint, chunk bigint, kind string, key binary, value binary, headers array<struct<key:string,value:binary>>, ev_id bigint"
LOG = RECORD + ", batch_id bigint, attempt string"
MARK = "batch_tick bigint, chunk bigint, batch_id bigint, attempt string"
END = "topic string, next_offset bigint, due_us bigint"


def closed_window(log: DataFrame, fresh: DataFrame) -> tuple[DataFrame, dict, dict] | None:
    """The ticks a micro-batch closes together with the one before them, and the snapshots at both ends.

    ``log`` is the whole tick log, ``fresh`` the new rows of it. The first tick of a log closes nothing: it is where the
    subscription starts. Nothing to close gives None."""
    span = fresh.agg(F.min("tick_id").alias("low"), F.max("tick_id").alias("high")).first()
    if span["low"] is None:
        return None
    before = log.where(F.col("tick_id") < span["low"]).agg(F.max("tick_id").alias("t")).first()["t"]
    low = span["low"] if before is None else before
    if low == span["high"]:
        return None
    window = log.where(F.col("tick_id").between(low, span["high"]))
    ends = {r["tick_id"]: r.asDict() for r in window.where(F.col("tick_id").isin(low, span["high"])).collect()}
    return window, ends[low], ends[span["high"]]


def window_batches(events: DataFrame, window: DataFrame, first: dict, last: dict) -> DataFrame:
    """The events of all batches of a window, with ``batch_tick``. The transactions to read reach the scan as literals."""
    rows = batch_events(events, first, last)
    return assign_batches(rows, window).where(F.col("batch_tick") > first["tick_id"])


def boundary_value(kind: str, epoch: str, end: Column) -> Column:
    """The JSON boundary record: version, epoch and the end of the batch."""
    stamp = F.date_format(F.to_utc_timestamp(end, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.rtrim(F.lpad(F.pmod(F.unix_micros(end), F.lit(1_000_000)).cast("string"), 6, "0"), F.lit("0"))
    fraction = F.when(micros == "", F.lit("")).otherwise(F.concat(F.lit("."), micros))
    return F.concat(
        F.lit(f'{{"{kind}":{{"version":1,"source_epoch":'), json_quote_exact(F.lit(epoch)), F.lit(',"committed_before":"'), stamp, fraction, F.lit('Z"}}')
    )


class Log:
    """A published log in a folder: rows, markers of complete chunks, ends by micro-batch."""

    def __init__(self, spark: SparkSession, path: str, fenced: bool = True):
        self.spark, self.path, self.fenced = spark, path, fenced

    def _table(self, name: str, ddl: str, *within: str) -> DataFrame:
        """A table that is there from the first read on, in folders by micro-batch and ``within``."""
        place = f"{self.path}/{name}"
        self.spark.createDataFrame([], ddl).write.mode("ignore").partitionBy("batch_id", *within).parquet(place)
        return self.spark.read.schema(ddl).parquet(place)

    def rows(self) -> DataFrame:
        """Everything that was written, torn chunks included."""
        return self._table("rows", LOG, "attempt")

    def read(self) -> DataFrame:
        """What a reader sees: marked chunks, or everything where there is no fence."""
        rows = self.rows()
        if not self.fenced:
            return rows
        return rows.join(self.marks(), ["batch_id", "attempt", "batch_tick", "chunk"], "left_semi").select(*rows.columns)

    def marks(self) -> DataFrame:
        return self._table("marks", MARK)

    def end_before(self, batch_id: int) -> DataFrame:
        """Next offset and last boundary time per topic, as the micro-batch before recorded them."""
        ends = self._table("ends", END + ", batch_id bigint")
        return ends.where(F.col("batch_id") == batch_id - 1).drop("batch_id")

    def publish(self, rows: DataFrame, batch_id: int) -> None:
        """One wave: rows, then the markers of its chunks."""
        attempt = uuid.uuid4().hex
        place = [F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(attempt).alias("attempt")]
        rows.select("*", *place).write.mode("append").partitionBy("batch_id", "attempt").parquet(f"{self.path}/rows")
        if self.fenced:
            written = self.rows().where((F.col("batch_id") == batch_id) & (F.col("attempt") == attempt))
            marks = written.select("batch_tick", "chunk").distinct().select("*", *place)
            marks.coalesce(1).write.mode("append").partitionBy("batch_id").parquet(f"{self.path}/marks")

    def record_end(self, ends: DataFrame, batch_id: int) -> None:
        ends.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ends/batch_id={batch_id}")


def staged(records: DataFrame, place: str) -> DataFrame:
    """Encoded records written once, in ranges of (tick, id), with the range and the place within it."""
    spark = records.sparkSession
    size = envelope.record_size(F.col("key"), F.col("value"), F.col("headers"))
    own = F.monotonically_increasing_id()
    rows = sized(records).sortWithinPartitions("batch_tick", "ev_id", "key", "value")
    rows = rows.select("*", size.alias("size"), F.shiftright(own, 33).alias("_range"), own.bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))
    rows.write.mode("overwrite").parquet(place)
    return spark.read.schema(rows.schema).parquet(place)


def counts(rows: DataFrame) -> DataFrame:
    """Staged records per range, tick and topic."""
    return rows.groupBy("_range", "batch_tick", "topic").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"), F.max("size").alias("_top"))


def numbered(
    rows: DataFrame, counted: DataFrame, ticks: DataFrame, ends: DataFrame, topics: Sequence[str], batch: int, batch_bytes: int, marks: DataFrame
) -> DataFrame:
    """Staged records and the boundaries ``marks(batch_tick, topic, ...)`` with ``offset`` and ``chunk``.

    ``counted`` are the ``counts`` of ``rows``, ``ticks(batch_tick)`` the batches of the micro-batch. Offsets go on from
    ``ends``; a topic that is not there starts at 0."""
    # Every topic has a row for every tick, so that boundaries find their place too. Topics are few.
    grid = ticks.select("batch_tick", F.explode(F.array(*[F.lit(t) for t in topics])).alias("topic"))
    grid = grid.join(marks.select("batch_tick", "topic", F.lit(1).alias("_m")), ["batch_tick", "topic"], "left")
    grid = grid.select(F.lit(1 << 40).cast("bigint").alias("_range"), "batch_tick", "topic", F.lit(0).cast("bigint").alias("_n"), F.coalesce("_m", F.lit(0)).alias("_m"))
    both = counted.select("_range", "batch_tick", "topic", "_n", F.lit(0).alias("_m")).unionByName(grid)
    # One row per range, tick and topic: ranges and ticks follow the cluster and the clock.
    before = Window.partitionBy("topic").orderBy("batch_tick", "_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = both.select("_range", "batch_tick", "topic", F.coalesce(F.sum(F.col("_n") + F.col("_m")).over(before), F.lit(0)).alias("_start"))
    starts = starts.join(ends.select("topic", "next_offset"), "topic", "left")
    starts = starts.select("_range", "batch_tick", "topic", (F.col("_start") + F.coalesce("next_offset", F.lit(0))).alias("_start"))

    per_tick = counted.groupBy("_range", "batch_tick").agg(F.sum("_n").alias("_n"), F.min("_first").alias("_first"))
    within = Window.partitionBy("batch_tick").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    places = per_tick.select("_range", "batch_tick", "_first", F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_range", "batch_tick", "topic").orderBy("_row")) - 1
    placed = rows.withColumn("_rank", rank if len(topics) > 1 else F.lit(0)).join(places, ["_range", "batch_tick"])
    if len(topics) == 1:
        placed = placed.withColumn("_rank", F.col("_row") - F.col("_first"))
    placed = placed.withColumn("_pos", F.col("_before") + F.col("_row") - F.col("_first"))
    placed = placed.join(starts, ["_range", "batch_tick", "topic"]).withColumn("offset", F.col("_start") + F.col("_rank"))

    # Where even the largest records fill a chunk by number only, the number says the chunk.
    wide = counted.groupBy("batch_tick").agg(F.max("_top").alias("_top")).where(F.col("_top") * batch > batch_bytes).select("batch_tick")
    data = placed.withColumn("chunk", F.expr(f"_pos div {batch} + 1"))
    if not wide.isEmpty():
        plain = data.join(wide, "batch_tick", "left_anti")
        cut = placed.join(wide, "batch_tick", "left_semi").select("batch_tick", F.col("_pos").alias("ev_id"), "size")
        cut = envelope.chunk_records(cut, ["batch_tick"], batch, batch_bytes).select("batch_tick", F.col("ev_id").alias("_pos"), "chunk")
        data = plain.unionByName(placed.join(cut, ["batch_tick", "_pos"]))
    data = data.withColumn("kind", F.lit("data"))

    last = data.groupBy("batch_tick").agg(F.max("chunk").alias("_last"))
    control = marks.join(starts.where(F.col("_range") == F.lit(1 << 40)), ["batch_tick", "topic"]).join(last, "batch_tick", "left")
    control = control.select(
        "topic", F.col("_start").alias("offset"), "batch_tick", (F.coalesce("_last", F.lit(0)) + 1).cast("bigint").alias("chunk"), F.lit("boundary").alias("kind"),
        "key", "value", F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"), F.lit(None).cast("bigint").alias("ev_id"),
    )
    columns = control.columns
    return data.select(*columns).unionByName(control.select(*columns))


def deliver(
    events: DataFrame, tick_log: DataFrame, fresh: DataFrame, batch_id: int, encode: Callable[[DataFrame], DataFrame], log: Log, topics: Sequence[str],
    epoch: str, batch: int = CHUNK_ROWS, batch_bytes: int = CHUNK_BYTES, every_us: int = 0, wave: int | None = None, progress_key: str | None = None,
) -> None:
    """Deliver the batches that the new ticks close. ``every_us`` is the least time between boundaries, 0 for none;
    ``wave`` the number of chunks published together, all of them unless it is given; ``progress_key`` the name of the
    boundary field."""
    if not 0 < len(topics) <= MAX_TOPICS:
        raise ValueError(f"between 1 and {MAX_TOPICS} topics")
    spark = events.sparkSession
    ends = log.end_before(batch_id)
    found = closed_window(tick_log, fresh)
    if found is None:
        log.record_end(ends, batch_id)
        return
    window, first, last = found
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = window_batches(events, window, first, last).repartitionByRange(tasks, "batch_tick", "ev_id")
    records = staged(encode(rows), f"{log.path}/staged/batch_id={batch_id}")

    closed = window.where(F.col("tick_id") > first["tick_id"])
    ticks = closed.select(F.col("tick_id").alias("batch_tick"))
    due = closed.select("tick_id", "tick_time", F.unix_micros("tick_time").alias("end_us"), F.lit(True).alias("_new"))
    if every_us:
        # The last boundary decides when the next is due, so it goes in front of this micro-batch's batches.
        since = ends.agg(F.max("due_us").alias("end_us")).where(F.col("end_us").isNotNull())
        since = since.select(F.lit(first["tick_id"]).cast("bigint").alias("tick_id"), F.timestamp_micros("end_us").alias("tick_time"), "end_us", F.lit(False).alias("_new"))
        due = due_batches(due.unionByName(since).withColumn("stream", F.lit(0)), every_us).where("_new")
    else:
        due = due.limit(0)
    # A row per batch, from greedy cuts over all of them; numbers, boundaries and ends read it six times over.
    due = due.persist()
    kind = progress_key or PROGRESS["fenced" if log.fenced else "managed"]
    marks = due.select(
        F.col("tick_id").alias("batch_tick"), F.explode(F.array(*[F.lit(t) for t in topics])).alias("topic"),
        utf8(F.lit(epoch)).alias("key"), utf8(boundary_value(kind, epoch, F.col("tick_time"))).alias("value"),
    )
    # A row per range, tick and topic, read five times over.
    counted = counts(records).persist()
    try:
        out = numbered(records, counted, ticks, ends, topics, batch, batch_bytes, marks)
        if log.fenced:
            done = log.marks().where(F.col("batch_id") == batch_id).select("batch_tick", "chunk").distinct()
            out = out.join(done, ["batch_tick", "chunk"], "left_anti").select(*out.columns)
        for part in waves(out, wave) if wave else [out]:
            log.publish(part, batch_id)

        # Every record and boundary has one offset, in whichever attempt it was published.
        more = counted.select("topic", "_n").unionByName(marks.select("topic", F.lit(1).cast("bigint").alias("_n")))
        published = more.groupBy("topic").agg(F.sum("_n").alias("_more"))
        at = due.agg(F.max("end_us").alias("_due"))
        all_topics = spark.createDataFrame([(t,) for t in topics], "topic string").join(ends, "topic", "full").join(published, "topic", "left")
        all_topics = all_topics.withColumn("_due", at.scalar())
        log.record_end(all_topics.select("topic", (F.coalesce("next_offset", F.lit(0)) + F.coalesce("_more", F.lit(0))).cast("bigint").alias("next_offset"), F.coalesce("_due", "due_us").alias("due_us")), batch_id)
    finally:
        # Also where publishing fails: the batch is staged anew, at the same place, when it is repeated.
        counted.unpersist()
        due.unpersist()


def waves(rows: DataFrame, wave: int) -> list[DataFrame]:
    """The rows in parts of ``wave`` chunks, in order of ticks and chunks. Only the number of parts reaches the driver."""
    per_tick = rows.groupBy("batch_tick").agg(F.min("chunk").alias("_low"), F.max("chunk").alias("_high"))
    before = Window.partitionBy(F.lit(0)).orderBy("batch_tick").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_tick.select("batch_tick", "_low", F.coalesce(F.sum(F.col("_high") - F.col("_low") + 1).over(before), F.lit(0)).alias("_serial"), (F.col("_high") - F.col("_low") + 1).alias("_n"))
    total = firsts.agg(F.max(F.col("_serial") + F.col("_n")).alias("n")).first()["n"] or 0
    serial = rows.join(firsts.drop("_n"), "batch_tick").withColumn("_wave", F.expr(f"(_serial + chunk - _low) div {wave}"))
    return [serial.where(F.col("_wave") == k).select(*rows.columns) for k in range(-(-total // wave))]


def batch_stream(
    fresh: DataFrame, events: DataFrame, tick_log: DataFrame, encode: Callable[[DataFrame], DataFrame], log: Log, topics: Sequence[str], epoch: str,
    checkpoint: str, name: str | None = None, every: str | None = None, **settings,
) -> StreamingQuery:
    """Start delivery of the batches that ``fresh``, a stream of ticks in order, closes. ``tick_log`` is the same log as a
    table. ``every`` is a processing-time trigger; without it, what is there is delivered and the query ends."""

    def step(ticks: DataFrame, batch_id: int) -> None:
        deliver(events, tick_log, ticks.persist(), batch_id, encode, log, topics, epoch, **settings)
        ticks.unpersist()

    writer = fresh.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
