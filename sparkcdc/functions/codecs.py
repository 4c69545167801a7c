"""Byte and identity helpers: big-endian integers, stable uuids, digests, name patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings of identifiers.
STREAM_NAME = r"^[a-z][a-z0-9_-]{0,62}$"
SCHEMA_NAME = r"^[a-z_][a-z0-9_]*$"
DELIVERY_ID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
POSITIVE_DECIMAL = r"^[1-9][0-9]*$"


def int8_bytes(n: Column) -> Column:
    """64-bit integer as 8 big-endian bytes (two's complement)."""
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 16, "0"))


def int4_bytes(n: Column) -> Column:
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 8, "0"))


def bytes_int8(b: Column) -> Column:
    """First 8 bytes as a non-negative integer; null when the top bit is set or bytes are missing."""
    text = F.hex(F.substring(b, 1, 8))
    ok = (F.octet_length(b) >= 8) & text.rlike("^[0-7]")
    return F.when(ok, F.conv(text, 16, 10).cast("bigint"))


def stable_uuid(n: Column) -> Column:
    """The uuid that carries an integer in its last 12 hex digits."""
    return F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(F.lower(F.hex(n.cast("bigint"))), 12, "0"))


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def b64(raw: Column) -> Column:
    """Unbroken base64 text."""
    return F.replace(F.base64(raw), F.lit("\r\n"), F.lit(""))


def unb64(text: Column) -> Column:
    """Bytes of base64 text, line breaks allowed; null when it is not base64."""
    return F.try_to_binary(F.replace(F.replace(text, F.lit("\n"), F.lit("")), F.lit("\r"), F.lit("")), F.lit("base64"))


def content_digest(key: Column, value: Column) -> Column:
    """sha256 of the JSON array holding base64(key) and base64(value); a null side is JSON null."""

    def token(raw: Column) -> Column:
        return F.coalesce(F.concat(F.lit('"'), b64(raw), F.lit('"')), F.lit("null"))

    return F.sha2(F.concat(F.lit("["), token(key), F.lit(","), token(value), F.lit("]")), 256)
