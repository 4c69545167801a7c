"""Secret scans with structural confirmation.

Base patterns are reported as they match. Beyond them, runs that look like base64, hex, a PEM block or
a signed token are decoded, and reported only if what comes out has the structure of a key or token:
nested DER lengths that fill each other exactly, the length-prefixed fields of an OpenSSH key, a token
header and claims that are JSON objects, or text that holds a base secret itself. Text is UTF-8 without control
characters other than white space. A run is also read from behind each ``/``, ``_`` and ``-`` in it, since a path
or a name may be glued on, and runs on lines that follow each other are read as one: for a DER or OpenSSH key up
to the line end where its structure ends, for text in lines of one width and a shorter last one, or all lines.
Inside a PEM block lines are read alone, the block being reported as such.

Spans are code points, end exclusive. A null or empty text has no spans. Ties go by start, then kind
in the order of ``KINDS``, then end. Every pattern is anchored so that a text of any length is read in
linear time; a row is scanned on its own, so repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds in reporting order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
BASE_KINDS = ("assign", "access", "hex")
ASSIGN_LEAST = 12
#: Kinds the method adds.
KINDS = (*BASE_KINDS, "jwt", "pem", "der", "ssh", "encoded")

_JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
_HEX = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}(?:\r?\n[0-9A-Fa-f]+)*(?![0-9A-Za-z])")
_LEAST_HEX = 32
#: Line widths of the usual encoders: a shorter line after one belongs to it even if it is not padded.
_WIDTHS = (64, 76)
#: What text does not hold; bytes that are not UTF-8 are decoded to lone surrogates.
_NOT_TEXT = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x84\x86-\x9f\ud800-\udfff]")
_URLSAFE = str.maketrans("-_", "+/")
_DEEPEST = 32
_OPENSSH = b"openssh-key-v1\x00"


def decode_base64(run: str) -> bytes | None:
    """Bytes of a base64 or base64url run, padded or not; None if its length cannot be right."""
    run = run.rstrip("=").translate(_URLSAFE)
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fields(data: bytes, at: int, end: int, depth: int = 0) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill data[at:end] exactly, nested ones checked as well."""
    fields = []
    while at < end:
        if depth > _DEEPEST or at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > end or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + width], "big")
            if size < 0x80:
                return None
            at += width
        if at + size > end:
            return None
        if tag & 0x20 and der_fields(data, at, at + size, depth + 1) is None:
            return None
        fields.append((tag, at, at + size))
        at += size
    return fields


def is_der_key(data: bytes) -> bool:
    """A private key: a version and key fields (RSA, EC, PKCS 8), or an encrypted PKCS 8 pair."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    outer = der_fields(data, 0, len(data))
    if not outer or len(outer) != 1:
        return False
    inner = der_fields(data, outer[0][1], outer[0][2])
    if not inner or len(inner) < 2:
        return False
    tags = [tag for tag, _, _ in inner]
    if tags[0] == 0x02:
        version = int.from_bytes(data[inner[0][1] : inner[0][2]], "big")
        numbers = len(tags) >= 6 and set(tags[1:]) <= {0x02, 0x30}
        return version <= 3 and (numbers or tags[1] == 0x04 or tags[1:3] == [0x30, 0x04])
    if tags == [0x30, 0x04]:
        named = der_fields(data, inner[0][1], inner[0][2])
        return bool(named) and named[0][0] == 0x06
    return False


def der_size(data: bytes, at: int) -> int | None:
    """Bytes of the sequence whose header is at ``at``, by that header alone."""
    if data[at : at + 1] != b"\x30" or at + 2 > len(data):
        return None
    size = data[at + 1]
    if size < 0x80:
        return 2 + size
    width = size & 0x7F
    return 2 + width + int.from_bytes(data[at + 2 : at + 2 + width], "big") if 1 <= width <= 4 else None


def ssh_size(data: bytes, at: int = 0) -> int | None:
    """Bytes of the OpenSSH private key at ``at``, by its length-prefixed fields."""
    if not data.startswith(_OPENSSH, at):
        return None
    start, at = at, at + len(_OPENSSH)

    def field() -> bool:
        nonlocal at
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at <= len(data)

    if not (field() and field() and field()) or at + 4 > len(data):
        return None
    count = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= count <= len(data):
        return None
    return at - start if all(field() for _ in range(count + 1)) else None


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key: length-prefixed fields that end where the data ends."""
    return ssh_size(data) == len(data)


def _json_object(part: str) -> dict | None:
    data = decode_base64(part)
    if not data or data.lstrip()[:1] != b"{":
        return None
    try:
        value = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(header: str, claims: str) -> bool:
    head = _json_object(header)
    return head is not None and isinstance(head.get("alg"), str) and _json_object(claims) is not None


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    if is_der_key(data):
        return "der"
    if is_ssh_key(data):
        return "ssh"
    if text_from(data) == 0 and base_spans(data.decode("utf-8"), hexes=False):
        return "encoded"
    return None


def text_from(data: bytes) -> int:
    """The least offset from which the rest is text."""
    return len(data) - len(_NOT_TEXT.split(data.decode("utf-8", "surrogateescape"))[-1].encode("utf-8"))


def _starts(run: str, lines: list[int]) -> list[int]:
    """Where something encoded may start: at a line's start or behind a mark that may belong to what precedes it."""
    return sorted({*lines, *(i + 1 for i, c in enumerate(run) if c in "/_-")})


class _Shifts:
    """A run decoded from each of its starts, at most once for each of the four ways its groups can fall."""

    def __init__(self, run: str):
        self.run = run
        self.found: dict[int, tuple[int, bytes]] = {}

    def at(self, start: int) -> tuple[bytes, int]:
        """Bytes, and the offset in them of what ``start`` begins."""
        if start % 4 not in self.found:
            rest = self.run[start:]
            self.found[start % 4] = start, decode_base64(rest[:-1] if len(rest) % 4 == 1 else rest) or b""
        first, data = self.found[start % 4]
        return data, (start - first) // 4 * 3


def _keys(run: str, lines: list[int]) -> list[tuple[str, int, int]]:
    """Keys that start at a start of the run and end at a line's end; ``lines`` are the lines' offsets."""
    found, shifts, ends, last = [], _Shifts(run), {*lines[1:], len(run)}, 0
    for start in _starts(run, lines):
        # The first six bits of a DER sequence and of an OpenSSH key.
        if start < last or run[start : start + 1] not in ("M", "b"):
            continue
        data, at = shifts.at(start)
        for kind, size, check in (("der", der_size(data, at), is_der_key), ("ssh", ssh_size(data, at), is_ssh_key)):
            if size is not None and start + (4 * size + 2) // 3 in ends and check(data[at : at + size]):
                last = start + (4 * size + 2) // 3
                found.append((kind, start, last))
    return found


def _text_start(run: str, lines: list[int]) -> int | None:
    """The first start from which the run is text that holds a base secret."""
    shifts, open_ = _Shifts(run), {}
    for start in _starts(run, lines):
        # What is less has no room for a secret.
        if len(run) - start < 16 or (len(run) - start) % 4 == 1:
            continue
        data, at = shifts.at(start)
        if start % 4 not in open_:
            open_[start % 4] = text_from(data)
        # Not inside a character.
        if at < open_[start % 4] or at >= len(data) or 0x80 <= data[at] < 0xC0:
            continue
        if base_spans(data[at:].decode("utf-8"), hexes=False):
            return start
        # What starts later holds less.
        open_[start % 4] = len(data)
    return None


def _readings(runs: list[str], i: int, padding: int) -> tuple[list[int], int]:
    """Line numbers up to which line i and those after it may be one text, longest first; and the first line
    that has another width."""
    width, end = len(runs[i]), i + 1
    glued = any(c in runs[i] for c in "/_-")
    if glued and end < len(runs) and len(runs[end]) < width:
        # The first line with something glued on is wider than those after it.
        following = len(runs[end])
        if following in _WIDTHS or end + 1 < len(runs) and len(runs[end + 1]) == following:
            width = following
    while end < len(runs) and len(runs[end]) == width:
        end += 1
    out = [end] if end == i + 1 else [end, i + 1]
    if end < len(runs) and len(runs[end]) < width:
        length = len(runs[end]) + (padding if end + 1 == len(runs) else 0)
        if ((end - i) * width + length) % 4 == 0 or glued and length % 4 == 0 or width in _WIDTHS:
            out.insert(0, end + 1)
    return out, end


def _base64_in(runs: list[str], padding: int) -> list[tuple[str, int, int]]:
    """What the lines of a match hold, by offsets in the joined lines."""
    joined, at = "".join(runs), [0]
    for run in runs:
        at.append(at[-1] + len(run))
    found = _keys(joined, at[:-1])
    taken = [any(s < at[i + 1] and e > at[i] for _, s, e in found) for i in range(len(runs))] if found else [False] * len(runs)

    def text(i: int, end: int) -> bool:
        start = None if any(taken[i:end]) else _text_start(joined[at[i] : at[end]], [a - at[i] for a in at[i:end]])
        if start is not None:
            found.append(("encoded", at[i] + start, at[end]))
        return start is not None

    i = 0
    while i < len(runs):
        ends, other = _readings(runs, i, padding)
        done = next((end for end in ends if text(i, end)), None)
        if done is not None:
            i = done
            continue
        for k in range(i, other):
            if taken[k] or (k > i and text(k, k + 1)):
                continue
            # A part between two marks, with something glued on at its end.
            for m in re.finditer(r"[A-Za-z0-9+]{24,}", runs[k]):
                kind = _key_kind(decode_base64(m[0]))
                if kind:
                    found.append((kind, at[k] + m.start(), at[k] + m.end()))
        i = other
    if not found and len(runs) > 1:
        text(0, len(runs))
    return found


def _hex_in(runs: list[str]) -> list[tuple[str, int, int]]:
    """The same for hex digits, which have no marks among them."""
    found, at = [], [0]
    for run in runs:
        at.append(at[-1] + len(run))

    def hexes(i: int, end: int) -> bool:
        run = "".join(runs[i:end])
        kind = _key_kind(bytes.fromhex(run)) if len(run) % 2 == 0 and len(run) >= _LEAST_HEX else None
        if kind:
            found.append((kind, at[i], at[end]))
        return kind is not None

    i = 0
    while i < len(runs):
        ends, other = _readings(runs, i, 0)
        if other < len(runs) and len(runs[other]) < len(runs[i]) and other + 1 not in ends:
            ends.insert(0, other + 1)
        done = next((end for end in ends if hexes(i, end)), None)
        if done is None:
            for k in range(i + 1, other):
                hexes(k, k + 1)
        i = other if done is None else done
    if not found and len(runs) > 1:
        hexes(0, len(runs))
    return found


def _lines(m: re.Match) -> list[tuple[int, int]]:
    """(start, end) of the run on each line of a match, padding left out."""
    out, at = [], m.start()
    for line in m[0].split("\n"):
        out.append((at, at + len(line.rstrip("\r="))))
        at += len(line) + 1
    return out


def _placed(text: str, m: re.Match, inside: Callable[[list[str]], list[tuple[str, int, int]]], alone: bool) -> list[tuple[str, int, int]]:
    """``inside`` over a match's lines, or over each alone, as spans of the text; padding belongs to the last line."""
    found, lines = [], _lines(m)
    for group in [[line] for line in lines] if alone else [lines]:
        at = [0]
        for start, end in group:
            at.append(at[-1] + end - start)
        for kind, start, end in inside([text[a:b] for a, b in group]):
            i, j = bisect_right(at, start) - 1, bisect_left(at, end) - 1
            last = group[j][0] + end - at[j]
            found.append((kind, group[i][0] + start - at[i], m.end() if last == lines[-1][1] else last))
    return found


def base_spans(text: str, hexes: bool = True) -> list[tuple[str, int, int]]:
    """The base kinds, leftmost and non-overlapping within each kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    if hexes:
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """What decodes to the structure of a key or token."""
    found = []
    if "-----BEGIN" in text:
        for m in _PEM.finditer(text):
            closing = f"-----END {m[1]}-----"
            following = text.find("-----BEGIN", m.end())
            end = text.find(closing, m.end(), following if following >= 0 else len(text))
            if end < 0:
                continue
            body = text[m.end() : end].replace("\\n", "\n")
            sealed = "ENCRYPTED" in m[1] or "ENCRYPTED" in body or m[1].endswith("BLOCK")
            data = decode_base64("".join(line for line in body.split() if ":" not in line and "," not in line))
            if data and (sealed or is_der_key(data) or is_ssh_key(data)):
                found.append(("pem", m.start(), end + len(closing)))
    if text.count(".") > 1:
        found += [("jwt", *m.span()) for m in _JWT.finditer(text) if is_signed_token(m[1], m[2])]
    blocks = [(start, end) for kind, start, end in found if kind == "pem"]

    def in_block(m: re.Match) -> bool:
        return any(m.start() < end and m.end() > start for start, end in blocks)

    for m in _BASE64.finditer(text):
        padding = len(m[0]) - len(m[0].rstrip("="))
        found += _placed(text, m, lambda runs: _base64_in(runs, padding), in_block(m))
    for m in _HEX.finditer(text):
        found += _placed(text, m, _hex_in, in_block(m))
    return found


_ORDER = {kind: place for place, kind in enumerate(KINDS)}


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, in reporting order."""
    if not text:
        return []
    return sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[1], _ORDER[s[0]], s[2]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _span_column(found: list[list[tuple[str, int, int]]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in found], type=_SPANS)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans`` of every row. No shuffle; a task holds one Arrow batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _span_column(found)], ["key", "spans"])

    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, f"key {narrow.schema['key'].dataType.simpleString()}, spans {SPANS}").withColumnRenamed("key", key)


def redacted(text: str, kinds: frozenset[str], mark: str) -> str:
    out, at = [], 0
    for kind, start, end in spans(text):
        if kind not in kinds or end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", kinds: tuple[str, ...] = KINDS,
           mark: str = "[secret]") -> DataFrame:
    """The documents with every span of ``kinds`` replaced by ``mark``; overlapping spans become one.
    ``n_chars``, if there is such a column, follows the text. A null text stays null."""
    chosen = frozenset(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [t if t is None else redacted(t, chosen, mark) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(clean, pa.string()), *batch.columns[1:]], names=batch.schema.names)

    rest = [c for c in docs.columns if c != text]
    moved = docs.select(F.col(f"`{text}`"), *[F.col(f"`{c}`") for c in rest])
    done = moved.mapInArrow(run, moved.schema)
    length = F.length(F.col(f"`{text}`")).cast("bigint")
    return done.select(*[length.alias(c) if c == n_chars else F.col(f"`{c}`") for c in docs.columns])


def span_text(spans_: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end, comma-joined, of all spans or of some kinds."""
    kept = spans_ if kinds is None else F.filter(spans_, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans_: Column, kind: str) -> Column:
    return F.size(F.filter(spans_, lambda s: s["kind"] == kind)).cast("bigint")
