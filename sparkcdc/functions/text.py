"""Text rendering: percent escaping, SQL quoting, value-to-text as the source database prints it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that must be quoted when used as an identifier (public SQL grammar of
# PostgreSQL: reserved, type-or-function and column-name keywords).
KEYWORDS = """
all analyse analyze and any array as asc asymmetric authorization between bigint binary bit
boolean both case cast char character check coalesce collate collation column concurrently
constraint create cross current_catalog current_date current_role current_schema current_time
current_timestamp current_user dec decimal default deferrable desc distinct do else end except
exists extract false fetch float for foreign freeze from full grant greatest group grouping having
ilike in initially inner inout int integer intersect interval into is isnull join json json_array
json_arrayagg json_exists json_object json_objectagg json_query json_scalar json_serialize
json_table json_value lateral leading least left like limit localtime localtimestamp merge_action
national natural nchar none normalize not notnull null nullif numeric offset on only or order out
outer overlaps overlay placing position precision primary real references returning right row
select session_user setof similar smallint some substring symmetric system_user table tablesample
then time timestamp to trailing treat trim true union unique user using values varchar variadic
verbose when where window with xmlattributes xmlconcat xmlelement xmlexists xmlforest xmlnamespaces
xmlparse xmlpi xmlroot xmlserialize xmltable
""".split()


def urlencode(text: Column) -> Column:
    """Percent-escape: letters, digits and ``-_.`` stay, space becomes ``+``, the rest lower-case ``%xx``.

    The JVM encoder does the byte work; it keeps ``*`` and prints upper-case hex, so only the
    pieces that follow a ``%`` are touched up.
    """
    pieces = F.split(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), "%")
    fixed = F.transform(
        pieces,
        lambda piece, i: F.when(i == 0, piece).otherwise(
            F.concat(F.lower(F.substring(piece, 1, 2)), F.substr(piece, F.lit(3)))
        ),
    )
    return F.array_join(fixed, "%")


def quote_literal(text: Column) -> Column:
    """SQL string literal; null stays null. Backslashes force the ``E'..'`` form."""
    doubled = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    prefix = F.when(F.contains(text, F.lit("\\")), F.lit("E'")).otherwise(F.lit("'"))
    return F.concat(prefix, doubled, F.lit("'"))


def quote_nullable(text: Column) -> Column:
    """As quote_literal, but null becomes the word NULL."""
    return F.coalesce(quote_literal(text), F.lit("NULL"))


def quote_ident(name: Column) -> Column:
    """Identifier, quoted unless it is a plain lower-case word and no keyword."""
    plain = name.rlike("^[a-z_][a-z0-9_]*$") & ~name.isin(KEYWORDS)
    return F.when(plain, name).otherwise(F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"')))


def quote_ident_text(name: str) -> str:
    """quote_ident for a name known while the plan is built."""
    import re

    if re.fullmatch(r"[a-z_][a-z0-9_]*", name) and name not in KEYWORDS:
        return name
    return '"' + name.replace('"', '""') + '"'


def quote_fqname(name: Column) -> Column:
    """``schema.table`` with both parts quoted; the first dot splits, no dot means ``public``."""
    dot = F.instr(name, ".")
    schema = F.when(dot > 0, F.substr(name, F.lit(1), dot - 1)).otherwise(F.lit("public"))
    table = F.when(dot > 0, F.substr(name, dot + 1)).otherwise(name)
    return F.concat(quote_ident(schema), F.lit("."), quote_ident(table))


def json_quote(text: Column) -> Column:
    """A JSON string token; null stays null."""
    wrapped = F.to_json(F.struct(text.alias("a")))
    return F.when(text.isNotNull(), F.substr(wrapped, F.lit(6), F.length(wrapped) - 6))


def json_quote_exact(text: Column) -> Column:
    """A JSON string token byte for byte as the relay writes it: ``<``, ``>``, ``&`` and the two line separators
    as escapes, control characters in lower-case hex."""
    # ASCII without any of them only has its quotes and backslashes escaped.
    plain = text.rlike(r"""^[ !"#-%'-;=?-~]*+\z""")
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    quoted = out = json_quote(text)
    for code in (0x0B, *range(0x0E, 0x10), *range(0x1A, 0x20)):
        # An escape starts at a backslash that no odd run of backslashes before it quotes.
        out = F.regexp_replace(out, rf"(?<!\\)((?:\\\\)*)\\u{code:04X}", rf"$1\\u{code:04x}")
    # Most texts hold none of them: one search instead of a replacement each.
    out = F.when(F.contains(quoted, F.lit(r"\u00")), out).otherwise(quoted)
    for char in "<>&\u2028\u2029":
        out = F.replace(out, F.lit(char), F.lit(f"\\u{ord(char):04x}"))
    return F.when(plain, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(out)


def _fraction(ts: Column) -> Column:
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    digits = F.rtrim(F.lpad(micros.cast("string"), 6, "0"), F.lit("0"))
    return F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), digits))


def timestamp_text(ts: Column, iso: bool = False) -> Column:
    """Timestamp text with the shortest fraction; ``iso`` puts ``T`` between date and time."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss" if iso else "yyyy-MM-dd HH:mm:ss"
    return F.concat(F.date_format(ts, pattern), _fraction(ts))


def double_text(x: Column) -> Column:
    """Shortest round-trip decimal text: plain from 1e-4 up to 1e15, exponent form outside."""
    plain = F.regexp_replace(x.cast("decimal(38,22)").cast("string"), r"\.?0+$", "")
    raw = x.cast("string")
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    exponent = F.substring_index(raw, "E", -1).cast("int")
    sci = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")),
    )
    size = F.abs(x)
    return (
        F.when(x == 0, F.lit("0"))
        .when(F.isnan(x), F.lit("NaN"))
        .when(size == float("inf"), F.when(x > 0, F.lit("Infinity")).otherwise(F.lit("-Infinity")))
        .when((size >= 1e-4) & (size < 1e15), plain)
        .otherwise(sci)
    )


def value_text(col: Column, kind: T.DataType) -> Column:
    """Column value as text; booleans print as ``t``/``f``."""
    if isinstance(kind, T.BooleanType):
        return F.when(col, F.lit("t")).when(~col, F.lit("f"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return timestamp_text(col)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return double_text(col.cast("double"))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(col)))
    return col.cast("string")
