"""Rendering changes as queue events: JSON, URL-encoded or SQL text, with the writer's options."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcdc.functions.text import json_quote, quote_ident_text, quote_literal, quote_nullable, urlencode, value_text
from sparkcdc.operators.capture import row_json

EVENT_FIELDS = ("ev_type", "ev_extra1", "ev_extra2", "ev_extra3", "ev_extra4")


@dataclass(frozen=True)
class Options:
    """How changes of one table become events.

    ``pkey``: key columns. ``ignore``: columns kept out of the payload; an update of nothing else
    makes no event. ``backup``: old payload in ev_extra2. ``skip``: the write itself is dropped.
    ``deny``: any write is an error. ``when``: SQL condition on the row; false or null drops the
    event. ``fields``: event field to SQL expression. Columns named ``magic`` + type/extra1..4 set
    that field and stay out of the payload.
    """

    pkey: Sequence[str]
    ignore: Sequence[str] = ()
    backup: bool = False
    skip: bool = False
    deny: bool = False
    when: str | None = None
    fields: dict[str, str] = field(default_factory=dict)
    magic: str = "_ev_"
    schema: str = "public"
    table: str = "orders"

    def magic_columns(self, row: T.StructType) -> dict[str, str]:
        names = {self.magic + f.removeprefix("ev_"): f for f in EVENT_FIELDS}
        return {c: names[c] for c in row.names if c in names}

    def payload(self, row: T.StructType) -> list[T.StructField]:
        hidden = set(self.ignore) | set(self.magic_columns(row))
        return [f for f in row.fields if f.name not in hidden]


def _differs(columns: Sequence[str]) -> Column:
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col("old")[c].eqNullSafe(F.col("new")[c])
    return changed


def pkey_problem(options: Options) -> Column:
    """Reason why a change cannot be rendered, or null."""
    op = F.col("op")
    if not options.pkey:
        return F.when(op.isin("UPDATE", "DELETE"), F.lit("update or delete on a table without key"))
    return F.when((op == "UPDATE") & _differs(options.pkey), F.lit("key update not allowed"))


def json_data(row: Column, schema: T.StructType, options: Options) -> Column:
    shown = [f.name for f in options.payload(schema)]
    return row_json(row, schema, text_types=True, skip=[n for n in schema.names if n not in shown])


def urlencoded_data(row: Column, schema: T.StructType, options: Options) -> Column:
    pairs = []
    for f in options.payload(schema):
        name = urlencode(F.lit(f.name))
        text = urlencode(value_text(row[f.name], f.dataType))
        pairs.append(F.concat(name, F.coalesce(F.concat(F.lit("="), text), F.lit(""))))
    return F.when(row.isNotNull(), F.array_join(F.array(*pairs), "&"))


def sql_data(row: Column, schema: T.StructType, options: Options) -> Column:
    """Statement tail for the change. Which columns an UPDATE lists depends on both images; the
    values printed are those of ``row``."""
    keys = [f for f in schema.fields if f.name in options.pkey]
    shown = options.payload(schema)

    def text(f: T.StructField) -> Column:
        return value_text(row[f.name], f.dataType)

    def name(f: T.StructField) -> str:
        return quote_ident_text(f.name)

    columns = F.lit("(" + ",".join(name(f) for f in shown) + ") values (")
    values = F.array_join(F.array(*[F.coalesce(quote_literal(text(f)), F.lit("null")) for f in shown]), ",")
    inserted = F.concat(columns, values, F.lit(")"))

    def condition(f: T.StructField) -> Column:
        literal = F.concat(F.lit(name(f) + "="), quote_literal(text(f)))
        return F.coalesce(literal, F.lit(name(f) + " is null"))

    where = F.array_join(F.array(*[condition(f) for f in keys]), " and ") if keys else F.lit("")
    assignments = []
    for f in shown:
        if f.name in options.pkey:
            continue
        changed = ~F.col("old")[f.name].eqNullSafe(F.col("new")[f.name])
        assignments.append(F.when(changed, F.concat(F.lit(name(f) + "="), quote_nullable(text(f)))))
    listed = F.filter(F.array(*assignments), lambda a: a.isNotNull()) if assignments else F.array().cast("array<string>")
    fallback = F.concat(F.lit(name(keys[0]) + "="), quote_nullable(text(keys[0]))) if keys else F.lit("")
    sets = F.when(F.size(listed) > 0, F.array_join(listed, ",")).otherwise(fallback)
    updated = F.concat(sets, F.lit(" where "), where)
    return F.when(F.col("op") == "INSERT", inserted).when(F.col("op") == "UPDATE", updated).when(F.col("op") == "DELETE", where)


def _json_type(options: Options) -> Column:
    keys = ",".join('"' + k + '"' for k in options.pkey)
    return F.concat(
        F.lit('{"op":'), json_quote(F.col("op")), F.lit(',"table":['), json_quote(F.lit(options.schema)), F.lit(","),
        json_quote(F.lit(options.table)), F.lit(f'],"pkey":[{keys}]}}'),
    )


def _letter(suffix: str) -> Column:
    op = F.col("op")
    return (
        F.when(op == "INSERT", F.lit("I" + suffix))
        .when(op == "UPDATE", F.lit("U" + suffix))
        .when(op == "DELETE", F.lit("D" + suffix))
        .when(op == "TRUNCATE", F.lit("R"))
    )


def _render(changes: DataFrame, options: Options, data_of, kind: Column, empty: str) -> DataFrame:
    schema = changes.schema["new"].dataType
    main = F.when(F.col("op") == "DELETE", F.col("old")).otherwise(F.col("new"))
    others = [c for c in changes.columns if c not in ("op", "old", "new")]
    problem = pkey_problem(options)
    if options.deny:
        problem = F.coalesce(F.concat(F.lit("change not allowed: "), F.col("op")), problem)
    op = F.when(problem.isNotNull(), F.raise_error(problem).cast("string")).otherwise(F.col("op"))
    guarded = changes.select(*others, op.alias("op"), "old", "new")
    truncated = F.col("op") == "TRUNCATE"
    new_data = F.when(truncated, F.lit(empty)).otherwise(data_of(main, schema, options))
    old_data = F.when(F.col("op") == "UPDATE", data_of(F.col("old"), schema, options))
    rows = guarded.select("*", new_data.alias("ev_data"), old_data.alias("_old_data"), main.alias("_main"))
    if options.ignore:
        silent = (F.col("op") == "UPDATE") & (F.col("_old_data") == F.col("ev_data")) & _differs(options.ignore)
        rows = rows.where(~F.coalesce(silent, F.lit(False)))
    fields = {
        "ev_type": kind,
        "ev_extra1": F.lit(f"{options.schema}.{options.table}"),
        "ev_extra2": F.col("_old_data") if options.backup else F.lit(None).cast("string"),
        "ev_extra3": F.lit(None).cast("string"),
        "ev_extra4": F.lit(None).cast("string"),
    }
    for column, target in options.magic_columns(schema).items():
        fields[target] = F.when(truncated, fields[target]).otherwise(F.col("_main")[column].cast("string"))
    rows = rows.select(*others, "op", "ev_data", "_main", *[v.alias("_f_" + k) for k, v in fields.items()])
    # User expressions see the main image's columns by name.
    opened = rows.select(
        *[F.col(c).alias("_c_" + c) for c in others], F.col("op").alias("_c_op"), "ev_data", *["_f_" + k for k in fields], "_main.*"
    )
    if options.when is not None:
        opened = opened.where((F.col("_c_op") == "TRUNCATE") | F.coalesce(F.expr(options.when).cast("boolean"), F.lit(False)))
    final = []
    for k in fields:
        value = F.col("_f_" + k)
        if k in options.fields:
            value = F.when(F.col("_c_op") == "TRUNCATE", value).otherwise(F.expr(options.fields[k]).cast("string"))
        final.append(value.alias(k))
    return opened.select(*[F.col("_c_" + c).alias(c) for c in others], F.col("_c_op").alias("op"), "ev_data", *final)


def render_json(changes: DataFrame, options: Options) -> DataFrame:
    """Events with a JSON type (op, table, key) and the row as JSON in column order."""
    return _render(changes, options, json_data, _json_type(options), "{}")


def render_urlencoded(changes: DataFrame, options: Options) -> DataFrame:
    """Events typed ``I:keys`` with the row as ``col=value&col``; a null column has no ``=``."""
    return _render(changes, options, urlencoded_data, _letter(":" + ",".join(options.pkey)), "")


def render_sql(changes: DataFrame, options: Options) -> DataFrame:
    """Events typed ``I``, ``U``, ``D`` with the tail of the statement that repeats the change."""
    return _render(changes, options, sql_data, _letter(""), "")


def redirect(changes: DataFrame, options: Options, render=render_json) -> tuple[DataFrame, DataFrame]:
    """The writes that still reach the table and the events: with ``skip`` no write does."""
    writes = changes.limit(0) if options.skip else changes
    return writes, render(changes, options)
