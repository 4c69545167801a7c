"""Delivery: reading closed batches as a stream, encoding, publishing, acknowledging.

A batch is handed to ``foreachBatch`` under a batch id. The checkpoint moves only after the publish
function returns, which is the acknowledgement of the source: a crash in between replays the same
batch under the same id. Two ways to publish:

* fenced: the batch goes to its own directory, which a replay overwrites with the same bytes, and a
  marker is written last; readers see only marked batches.
* managed: plain append, at least once; readers remove duplicates by delivery id.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkcdc.functions.codecs import utf8
from sparkcdc.operators import envelope, outbox
from sparkcdc.session import dealt

RECORD_DDL = "topic string, key binary, value binary, headers array<struct<key:string,value:binary>>, ev_id bigint"

# Restart pauses of a failing stream and how many streams one process takes.
FIRST_PAUSE_S, LAST_PAUSE_S = 1, 5
#: Fixed value: a run that lasts longer counts as healthy.
HEALTHY_S = 10
POLL_S = 0.2
MAX_STREAMS = 32


def cdc_encoder(epoch: str, routes: DataFrame | None = None, default_topic: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """Events to records in the JSON envelope. A change that does not decode or route fails the batch,
    with a reason that never shows the payload."""

    def encode(batch: DataFrame) -> DataFrame:
        decoded = envelope.check_change(batch, "ev_data")
        routed = envelope.route_changes(decoded, routes, default_topic)
        value = envelope.legacy_envelope(F.lit(epoch), F.col("ev_id"), F.col("ev_data"))
        checked = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("string")).otherwise(value)
        return routed.select(
            "topic",
            utf8(F.lit(epoch)).alias("key"),
            utf8(checked).alias("value"),
            F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
            "ev_id",
            *_kept(batch),
        )

    return encode


def outbox_encoder(topic: str) -> Callable[[DataFrame], DataFrame]:
    """Wrappers to records, byte for byte."""

    def encode(batch: DataFrame) -> DataFrame:
        rows = outbox.decode(batch, "ev_data")
        value = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("binary")).otherwise(F.col("value"))
        return rows.select(F.lit(topic).alias("topic"), "key", value.alias("value"), "headers", "ev_id", *_kept(batch))

    return encode


def _kept(batch: DataFrame) -> list[str]:
    """The batch of an event, where the source says it."""
    return [c for c in ("batch_tick",) if c in batch.columns]


def sized(records: DataFrame) -> DataFrame:
    """Refuse records over the wire limit; nothing is cut."""
    size = envelope.record_size(F.col("key"), F.col("value"), F.col("headers"))
    over = size > envelope.MAX_RECORD_BYTES
    value = F.when(over, F.raise_error(F.lit("encoded record exceeds the byte limit")).cast("binary")).otherwise(F.col("value"))
    return records.withColumn("value", value)


def fenced_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Publish each batch to its own directory and mark it complete last."""

    def publish(records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        records.write.mode("overwrite").parquet(f"{path}/batches/batch_id={batch_id}")
        marker = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"))
        marker.coalesce(1).write.mode("overwrite").parquet(f"{path}/markers/marker={batch_id}")

    return publish


def read_fenced(spark: SparkSession, path: str) -> DataFrame:
    """Only batches whose marker is there."""
    rows = spark.read.option("basePath", f"{path}/batches").schema(RECORD_DDL + ", batch_id bigint").parquet(f"{path}/batches")
    marks = spark.read.schema("batch_id bigint, marker bigint").parquet(f"{path}/markers").select("batch_id")
    return rows.join(marks, "batch_id", "left_semi")


def managed_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Publish by plain append: a replay appears again."""

    def publish(records: DataFrame, batch_id: int) -> None:
        records.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(path)

    return publish


def relay_stream(
    source: DataFrame,
    encode: Callable[[DataFrame], DataFrame],
    publish: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start the relay. ``every`` is a processing-time trigger; without it, what is there is relayed
    and the query ends."""

    def step(batch: DataFrame, batch_id: int) -> None:
        publish(sized(encode(dealt(batch, "ev_id"))), batch_id)

    writer = source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_streams(starters: dict[str, Callable[[], StreamingQuery]], pause=time.sleep, clock=time.monotonic, stop: Callable[[], bool] = lambda: False) -> dict[str, str]:
    """Run independent streams until each has ended by itself or ``stop()`` says so.

    One that fails, or cannot start, does not stop the others and does not move its source: it is started from
    its checkpoint after its own pause, 1 s at first and doubling up to 5 s, as often as it takes. A run that
    lasted longer than ``HEALTHY_S`` starts the pauses anew. Returns the last state per stream: ``done``, ``stopped``,
    or the class of the error it was waiting to recover from.
    """
    if not starters or len(starters) > MAX_STREAMS:
        raise ValueError(f"between 1 and {MAX_STREAMS} streams")
    running: dict[str, StreamingQuery] = {}
    began: dict[str, float] = {}
    waits = dict.fromkeys(starters, FIRST_PAUSE_S)
    due = dict.fromkeys(starters, clock())
    state: dict[str, str] = {}

    def failed(name: str, error: Exception) -> None:
        state[name] = type(error).__name__
        due[name] = clock() + waits[name]
        waits[name] = min(waits[name] * 2, LAST_PAUSE_S)

    while running or due:
        if stop():
            for name, query in running.items():
                query.stop()
                state[name] = "stopped"
            break
        for name in [n for n, at in due.items() if at <= clock()]:
            del due[name]
            began[name] = clock()
            try:
                running[name] = starters[name]()
            except Exception as error:  # noqa: BLE001  (whatever keeps a stream from starting is tried again)
                failed(name, error)
        for name, query in list(running.items()):
            if query.isActive:
                continue
            del running[name]
            error = query.exception()
            if error is None:
                state[name] = "done"
                continue
            if clock() - began[name] > HEALTHY_S:
                waits[name] = FIRST_PAUSE_S
            failed(name, error)
        pause(POLL_S)
    return state


def replay_check(log: DataFrame) -> DataFrame:
    """Ids delivered more than once, with how many different contents (key, value, headers) they had."""
    per_content = log.groupBy("id", _content().alias("_c")).agg(F.count("*").alias("_n"))
    both = per_content.groupBy("id").agg(F.sum("_n").alias("copies"), F.count("*").alias("contents"))
    return both.where(F.col("copies") > 1)


def applied(log: DataFrame, arrival: str | None = None) -> DataFrame:
    """A managed log with each event once, the way an idempotent consumer sees it: as it came first.

    ``arrival`` names the column that says in which order copies came (an offset, a batch); copies that came
    together, and all copies without it, are told apart by key and value. ``copies`` counts how often an event came,
    ``conflict`` says whether its copies differ in key, value or headers."""
    rest = [c for c in log.columns if c != "ev_id"]
    order = F.struct(*([arrival] if arrival else []), F.hex("key").alias("k"), F.hex("value").alias("v"))
    firsts = log.groupBy("ev_id").agg(
        F.min_by(F.struct(*rest), order).alias("_f"), F.count("*").alias("copies"), F.min(_content()).alias("_low"), F.max(_content()).alias("_high")
    )
    return firsts.select("ev_id", "_f.*", "copies", (F.col("_low") != F.col("_high")).alias("conflict"))


def _content() -> Column:
    """A digest of key, value and headers."""
    headers = F.transform("headers", lambda h: F.struct(h["key"].alias("k"), F.hex(h["value"]).alias("v")))
    whole = F.struct(F.hex("key").alias("key"), F.hex("value").alias("value"), headers.alias("headers"))
    return F.sha2(F.to_json(whole, {"ignoreNullFields": "false"}), 256)
