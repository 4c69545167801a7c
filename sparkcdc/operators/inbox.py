"""Idempotent apply: receipts, conflicts, and the latest image per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcdc.functions.codecs import content_digest


def with_digest(log: DataFrame) -> DataFrame:
    return log.withColumn("digest", content_digest(F.col("key"), F.col("value")))


def first_per_id(log: DataFrame, order: str = "offset") -> DataFrame:
    """The first record of each delivery id. A minimum over a struct combines map-side, so an id
    that is delivered over and over does not gather in one task."""
    rest = [c for c in log.columns if c not in ("id", order)]
    return log.groupBy("id").agg(F.min(F.struct(order, *rest)).alias("_f")).select("id", "_f.*")


def apply_inbox(log: DataFrame, receipts: DataFrame) -> DataFrame:
    """Effects to apply: the first record per delivery id that has no receipt yet.

    ``log(id, offset, digest, ...)``, ``receipts(id, digest)``. The result is also what the receipts
    table gains; write both under one batch id.
    """
    return first_per_id(log).join(receipts.select("id"), "id", "left_anti")


def inbox_conflicts(log: DataFrame, receipts: DataFrame) -> DataFrame:
    """Ids used for different content, within the log or against a receipt."""
    seen = log.groupBy("id").agg(F.min("digest").alias("_lo"), F.max("digest").alias("_hi"), F.count("*").alias("deliveries"))
    joined = seen.join(receipts.select("id", F.col("digest").alias("receipt_digest")), "id", "left")
    differs = (F.col("_lo") != F.col("_hi")) | (F.col("_lo") != F.col("receipt_digest"))
    return joined.where(differs).select(
        "id", "deliveries", (F.col("_lo") != F.col("_hi")).alias("in_log"), (F.col("_lo") != F.col("receipt_digest")).alias("against_receipt")
    )


def require_no_conflicts(effects: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Fail closed when any id carries two contents, also when nothing is left to apply: every
    conflict becomes a row whose evaluation stops the job."""
    # Tied to the conflict itself: a filter that a caller adds cannot run the error for other rows.
    text = F.concat(F.lit("delivery id reused for different content: "), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    differs = F.col("in_log") | F.coalesce("against_receipt", F.lit(False))
    stop = conflicts.select(F.when(differs, F.raise_error(text).cast("string")).alias("id"))
    return effects.unionByName(stop, allowMissingColumns=True)


def materialize(changes: DataFrame, keys: Sequence[str], order: str = "ev_id") -> DataFrame:
    """Latest image per key after ordered changes ``(order, op, old, new)``; deletes vanish.

    An update that moves the key counts as a delete of the old key and an insert of the new one.
    """

    def of(side: str) -> list[Column]:
        return [F.col(side)[k].alias(k) for k in keys]

    gone = F.lit(None).cast(changes.schema["new"].dataType)
    moved = F.lit(False)
    for k in keys:
        moved = moved | ~F.col("old")[k].eqNullSafe(F.col("new")[k])
    put = F.struct(*of("new"), F.col(order).alias("_at"), F.lit(1).alias("_rank"), F.col("new").alias("_image"))
    drop = F.struct(*of("old"), F.col(order).alias("_at"), F.lit(0).alias("_rank"), gone.alias("_image"))
    steps = (
        F.when(F.col("op") == "INSERT", F.array(put))
        .when(F.col("op") == "DELETE", F.array(drop))
        .when(moved, F.array(drop, put))
        .otherwise(F.array(put))
    )
    rows = changes.select(F.inline(steps))
    last = rows.groupBy(*keys).agg(F.max_by("_image", F.struct("_at", "_rank")).alias("_image"))
    return last.where(F.col("_image").isNotNull()).select("_image.*")


def invalidations(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cache keys to drop: every value of the named columns in either image, once."""
    pairs = []
    for c in columns:
        for side in ("old", "new"):
            pairs.append(F.struct(F.lit(c).alias("column"), F.col(side)[c].cast("string").alias("value")))
    return changes.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).dropDuplicates()
