"""Transaction visibility against a snapshot ``(xmin, xmax, xip)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAPSHOT = "struct<xmin:bigint,xmax:bigint,xip:array<bigint>>"


def visible(txid: Column, xmin: Column, xmax: Column, xip: Column) -> Column:
    """True when the transaction had ended before the snapshot was taken."""
    return (txid < xmin) | ((txid < xmax) & ~F.array_contains(xip, txid))


def parse_snapshot(text: Column) -> Column:
    """``xmin:xmax:x1,x2`` text to a struct."""
    parts = F.split(text, ":")
    xip = F.when(parts[2] == "", F.array().cast("array<bigint>")).otherwise(
        F.split(parts[2], ",").cast("array<bigint>")
    )
    return F.struct(parts[0].cast("bigint").alias("xmin"), parts[1].cast("bigint").alias("xmax"), xip.alias("xip"))


def snapshot_text(xmin: Column, xmax: Column, xip: Column) -> Column:
    return F.concat_ws(":", xmin.cast("string"), xmax.cast("string"), F.array_join(xip.cast("array<string>"), ","))
