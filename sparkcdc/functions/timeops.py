"""Interval arithmetic as integer microseconds, so results do not depend on float rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def micros_between(later: Column, earlier: Column) -> Column:
    return micros(later) - micros(earlier)


def plus_seconds(ts: Column, seconds: Column | float) -> Column:
    seconds = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_micros(micros(ts) + (seconds * 1_000_000).cast("bigint"))
