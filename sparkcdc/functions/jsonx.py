"""Strict JSON with exact numbers.

Spark's JSON readers accept trailing text and pass numbers through doubles or decimals. Here
every number token outside strings is first turned into a marked string (``tag``), so that any
reader keeps its digits; ``untag`` restores the text. A genuine string that starts with the
marker character has it doubled while tagged, so the two are never confused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "\u0001"
_NUMBER = (
    r'\G((?:[^"\-0-9]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+)(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?)'
)
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
MAX_DEPTH = 30
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def tag(raw: Column) -> Column:
    """Numbers become strings that start with the marker."""
    doubled = F.when(
        F.contains(raw, F.lit(r"\u0001")), F.regexp_replace(raw, r"(?<!\\)((?:\\\\)*+)\\u0001", r"$1\\u0001\\u0001")
    ).otherwise(raw)
    return F.regexp_replace(doubled, _NUMBER, r'$1"\\u0001$2"')


def untag(text: Column) -> Column:
    """JSON text with its numbers as they were written."""
    numbers = F.regexp_replace(text, r'"\\u0001(-?[0-9][0-9.eE+-]*+)"', "$1")
    return F.when(
        F.contains(numbers, F.lit(r"\u0001")),
        F.regexp_replace(numbers, r"(?<!\\)((?:\\\\)*+)\\u0001\\u0001", r"$1\\u0001"),
    ).otherwise(numbers)


def is_single_value(raw: Column) -> Column:
    """Exactly one well-formed JSON value and nothing after it.

    The readers stop at the bracket that closes the outer value, so text after it is caught by
    wrapping twice: what could close an array early cannot also close an object early.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), raw, F.lit("]"))) == 1
    in_object = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), raw, F.lit("}")))) == 1
    return F.coalesce(in_array & in_object, F.lit(False))


def is_object(raw: Column) -> Column:
    """Exactly one JSON object and nothing after it."""
    return is_single_value(raw) & raw.rlike(r"^[ \t\r\n]*\{")


def strict_object(raw: Column, shape: str) -> Column:
    """Read one JSON object and nothing else as ``array<shape>``; see ``only``.

    The text is placed in an array in front of an end marker made from its own hash. Anything after
    the object breaks the array, closes it before the marker, or adds an entry.
    """
    marked = F.concat(F.lit("["), tag(raw), F.lit(',{"_end":"'), F.md5(raw), F.lit('"}]'))
    return F.from_json(marked, f"array<{shape}>", STRICT)


def only(entries: Column, end: Column, raw: Column) -> Column:
    """Whether ``strict_object`` read exactly one object; ``end`` is the marker it found."""
    return F.coalesce(
        (F.size(entries) == 2) & (end == F.md5(raw)) & raw.rlike(r"^[ \t\r\n]*\{"), F.lit(False)
    )


def kind_of(token: Column) -> Column:
    """Kind of a rendered, tagged JSON token: null, bool, string, number, object, array."""
    first = F.substring(token, 1, 1)
    return (
        F.when(token.isNull(), F.lit(None).cast("string"))
        .when(token == "null", F.lit("null"))
        .when(first == "{", F.lit("object"))
        .when(first == "[", F.lit("array"))
        .when(first == '"', F.when(token.rlike(r'^"\\u0001-?[0-9]'), F.lit("number")).otherwise(F.lit("string")))
        .otherwise(F.lit("bool"))
    )


def word_of(value: Column) -> Column:
    """The string a tagged variant holds; null for every other kind. A doubled marker is undone."""
    return unmarked(text_of(value))


def text_of(value: Column) -> Column:
    """The text of a string or number in a tagged variant, still marked; null for other kinds."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def unmarked(text: Column) -> Column:
    """A tagged string as it was written; null when it stands for a number."""
    return F.when(~F.startswith(text, F.lit(MARK)), text).when(
        F.startswith(text, F.lit(MARK + MARK)), F.substr(text, F.lit(2))
    )


def number_of(value: Column) -> Column:
    """Exact text of the number a tagged variant holds; null for every other kind."""
    text = text_of(value)
    return F.when(text.rlike("^\u0001-?[0-9]"), F.substr(text, F.lit(2)))


def is_null_or_missing(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def too_deep(tagged: Column, limit: int = MAX_DEPTH) -> Column:
    """A value lies more than ``limit`` levels below the outer object.

    Text with no more brackets than levels cannot be too deep, so the scan over brackets is
    only ever done for the rare nested rows.
    """
    shape = F.regexp_replace(F.regexp_replace(tagged, _STRING, "v"), r"[\s,:]", "")
    shape = F.regexp_replace(F.regexp_replace(shape, "true|false|null", "v"), "v+", "v")
    opens = F.length(F.regexp_replace(shape, r"[^\[{]", ""))

    def step(acc: Column, c: Column) -> Column:
        opening, closing = c.isin("{", "["), c.isin("}", "]")
        now = acc["now"] + F.when(opening, 1).when(closing, -1).otherwise(0)
        deepest = F.when(closing, acc["top"]).otherwise(F.greatest(acc["top"], acc["now"]))
        return F.struct(now.alias("now"), deepest.alias("top"))

    walked = F.aggregate(F.split(shape, ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("top")), step)
    return F.when(opens >= limit, walked["top"] > limit).otherwise(F.lit(False))


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """Append columns that are computed once, here.

    A plain projection would be copied into every later filter and expression that reads it;
    the generator keeps costly parsing out of them.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
