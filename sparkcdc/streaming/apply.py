"""Idempotent apply of a record stream: receipts and effects commit together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkcdc.operators import inbox


def read_effects(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """Applied records; with ``before``, only those of earlier batches."""
    rows = spark.read.schema(schema + ", batch_id bigint").parquet(path)
    return rows if before is None else rows.where(F.col("batch_id") < before)


class Receipts:
    """Ids and digests that were applied, in folders ``run=<first>-<end>/bucket=<b>`` by micro-batch and hash of the id.

    A batch asks for the buckets its own ids fall into and opens no other file. Runs are merged as in a binary counter, so
    batch ``n`` finds one run per set bit of ``n`` and every receipt is rewritten once per doubling of the batches. A run is
    written whole before anything reads it, from runs that stay as they are until the batch after has begun, so a batch that
    is repeated finds what it found before. Ids that are null match no receipt.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, buckets: int = 256):
        self.spark, self.path, self.schema, self.buckets = spark, path, schema, buckets

    def bucket(self, ident: Column) -> Column:
        return F.pmod(F.xxhash64(ident), F.lit(self.buckets)).cast("int")

    @staticmethod
    def runs(end: int) -> list[tuple[int, int]]:
        """The runs that hold batches 0 to ``end - 1``."""
        out = []
        while end:
            first = end & (end - 1)
            out.append((first, end))
            end = first
        return out[::-1]

    def _place(self, run: tuple[int, int]) -> str:
        return f"{self.path}/run={run[0]}-{run[1]}"

    def _read(self, runs: list[tuple[int, int]]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], f"{self.schema}, bucket int")
        reader = self.spark.read.schema(f"{self.schema}, run string, bucket int").option("basePath", self.path)
        return reader.parquet(*[self._place(r) for r in runs]).drop("run")

    def _write(self, rows: DataFrame, run: tuple[int, int]) -> None:
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._place(run))

    def merged(self, batch_id: int) -> list[tuple[int, int]]:
        """The runs that become one when ``batch_id`` begins."""
        if not batch_id:
            return []
        first = batch_id & (batch_id - 1)
        return [r for r in self.runs(batch_id - 1) if r[0] >= first] + [(batch_id - 1, batch_id)]

    def begin(self, batch_id: int) -> None:
        """Merge what ``batch_id`` is the first to find merged, and empty what the batch before it merged."""
        parts = self.merged(batch_id)
        if len(parts) > 1:
            self._write(self._read(parts), self.runs(batch_id)[-1])
        old = self.merged(batch_id - 1) if batch_id else []
        for run in old if len(old) > 1 else []:
            self._write(self._read([]), run)

    def of(self, ids: DataFrame, batch_id: int) -> DataFrame:
        """Earlier receipts of ``ids(id)``, repeated ids or not."""
        asked = ids.select("id").distinct()
        # At most as many numbers as there are buckets.
        touched = [r["b"] for r in asked.select(self.bucket(F.col("id")).alias("b")).distinct().collect()]
        earlier = self._read(self.runs(batch_id)).where(F.col("bucket").isin(touched)).drop("bucket")
        return earlier.join(asked, "id", "left_semi")

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """The receipts of a batch; a repeated batch replaces its own."""
        self._write(rows.withColumn("bucket", self.bucket(F.col("id"))), (batch_id, batch_id + 1))


def inbox_stream(
    source: DataFrame, path: str, checkpoint: str, effect: Callable[[DataFrame], DataFrame] | None = None, buckets: int = 256
) -> StreamingQuery:
    """Apply each delivery id of ``source(id, offset, key, value)`` once, for ever.

    Each batch has a directory of effects and, under ``_receipts``, one of the ids and digests it saw first,
    whatever ``effect`` makes of the rows. A replayed batch overwrites its own two and ignores them while
    deduplicating. Of the earlier receipts only ``buckets`` that the batch has ids in are read. An id that comes back
    with other content stops the stream before anything is written. ``buckets`` must not change over a store's life.
    """
    ids = inbox.with_digest(source).select("id", "digest").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ids.fields)

    def step(batch: DataFrame, batch_id: int) -> None:
        store = Receipts(batch.sparkSession, f"{path}/_receipts", columns, buckets)
        store.begin(batch_id)
        log = inbox.with_digest(batch)
        receipts = store.of(log, batch_id)
        conflict = inbox.inbox_conflicts(log, receipts).select("id").first()
        if conflict is not None:
            raise ValueError(f"delivery id {conflict['id']} reused for different content")
        first = inbox.apply_inbox(log, receipts)
        store.add(first.select("id", "digest"), batch_id)
        effects = first if effect is None else effect(first)
        effects.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
