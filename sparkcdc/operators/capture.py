"""Capture: change events from two table versions or from a feed of written rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcdc.functions.text import json_quote, timestamp_text, value_text

# The byte limit of one captured change body.
MAX_CHANGE_BYTES = 524_288

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


def row_json(row: Column, schema: T.StructType, text_types: bool = False, skip: Sequence[str] = ()) -> Column:
    """JSON object of a row image in column order, nulls spelled out; null for a null image.

    Integers and booleans are JSON values, timestamps ISO text. Other types are JSON numbers or
    strings as they come, or with ``text_types`` always the text of the value.
    """
    parts = []
    for field in schema.fields:
        if field.name in skip:
            continue
        value, kind = row[field.name], field.dataType
        if isinstance(kind, WHOLE):
            pass
        elif isinstance(kind, T.DateType):
            value = value.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = timestamp_text(value, iso=True)
        elif text_types or isinstance(kind, T.BinaryType):
            value = value_text(value, kind)
        parts.append(value.alias(field.name))
    return F.when(row.isNotNull(), F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}))


def capture_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One change per row that differs between two versions: keys, ``op``, full ``old`` and ``new``.

    A row whose key is only in ``after`` is an INSERT, only in ``before`` a DELETE. Rows that are
    equal in all columns make no change (a writer that rewrites a row unchanged cannot be told
    apart from one that leaves it).
    """
    keys = list(keys)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*[F.col(c) for c in before.columns]).alias(name))

    joined = side(before, "old").join(side(after, "new"), keys, "full_outer")
    op = F.when(F.col("old").isNull(), F.lit("INSERT")).when(F.col("new").isNull(), F.lit("DELETE")).otherwise(F.lit("UPDATE"))
    return joined.where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, op.alias("op"), "old", "new")


def capture_feed(feed: DataFrame, schema: str, table: str) -> DataFrame:
    """Change events from a feed of ``(op, old, new)`` rows, batch or streaming, no state: the old
    image unless INSERT, the new one unless DELETE, and the body to store."""
    row = feed.schema["new"].dataType
    before = F.when(F.col("op") != "INSERT", row_json(F.col("old"), row))
    after = F.when(F.col("op") != "DELETE", row_json(F.col("new"), row))
    others = [c for c in feed.columns if c not in ("old", "new")]
    return feed.select(*others, change_body(F.lit(schema), F.lit(table), F.col("op"), before, after).alias("body"))


def change_body(schema: Column, table: Column, op: Column, before: Column, after: Column) -> Column:
    """The stored JSON text of a change; images are JSON text already and are not reparsed."""
    null = F.lit("null")
    return F.concat(
        F.lit('{"schema":'), json_quote(schema), F.lit(',"table":'), json_quote(table), F.lit(',"op":'), json_quote(op),
        F.lit(',"before":'), F.coalesce(before, null), F.lit(',"after":'), F.coalesce(after, null), F.lit("}"),
    )


def check_target(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``(table, null_keys, duplicate_keys, capturable)`` per named table.

    A table can be captured when it has a key and that key is never null and never repeated.
    """
    if not tables:
        raise ValueError("capture requires tables")
    report = None
    for name, (df, keys) in tables.items():
        if not name:
            raise ValueError("empty captured table")
        if not keys:
            raise ValueError(f"captured table {name} must have a key")
        missing = F.lit(False)
        for key in keys:
            missing = missing | F.col(key).isNull()
        per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
        row = per_key.agg(
            F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("null_keys"),
            F.count_if(~missing & (F.col("_n") > 1)).alias("duplicate_keys"),
        ).select(F.lit(name).alias("table"), "null_keys", "duplicate_keys")
        report = row if report is None else report.unionByName(row)
    return report.withColumn("capturable", (F.col("null_keys") == 0) & (F.col("duplicate_keys") == 0))


def oversize(df: DataFrame, column: str, limit: int = MAX_CHANGE_BYTES) -> DataFrame:
    """Rows whose text is over the byte limit."""
    return df.where(F.octet_length(column) > limit)


def enforce_size(df: DataFrame, column: str, limit: int = MAX_CHANGE_BYTES) -> DataFrame:
    """Fail the whole write on the first over-limit row; nothing is cut."""
    error = F.raise_error(F.lit(f"capture exceeds the limit of {limit} bytes")).cast("string")
    return df.withColumn(column, F.when(F.octet_length(column) > limit, error).otherwise(F.col(column)))


def truncates(feed: DataFrame) -> DataFrame:
    """TRUNCATE rows of a feed, which captured tables refuse."""
    return feed.where(F.col("op") == "TRUNCATE")


def reject_truncate(feed: DataFrame) -> DataFrame:
    """Fail on a TRUNCATE: it needs an explicit capture reset."""
    error = F.raise_error(F.lit("TRUNCATE requires an explicit capture reset")).cast("string")
    return feed.withColumn("op", F.when(F.col("op") == "TRUNCATE", error).otherwise(F.col("op")))


def key_moves(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Updates in which one of ``columns`` (key or association) differs, with both values kept."""
    moved = F.lit(False)
    for c in columns:
        moved = moved | ~F.col("old")[c].eqNullSafe(F.col("new")[c])
    pairs = [p for c in columns for p in (F.col("old")[c].alias(f"old_{c}"), F.col("new")[c].alias(f"new_{c}"))]
    others = [c for c in changes.columns if c not in ("old", "new")]
    return changes.where((F.col("op") == "UPDATE") & moved).select(*others, *pairs)


