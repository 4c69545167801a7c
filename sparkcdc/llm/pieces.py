"""SentencePiece encoding by vectorised merge rounds, and decoding.

All words of a slice of texts lie in one flat array of symbols. Each round looks up the least pair rank
of every word with one segmented minimum, merges the leftmost pair of that rank in all words at once,
compacts the array and asks for the ranks of the pairs that arose. Words without a pair leave; the rounds
end when no pair remains.

What is one word: a stretch between places that no piece can cross, because no piece holds the two
characters there side by side. A long word is laid out in segments of ``Model.reach`` symbols, and a segment
merges in a round only if neither neighbour holds an earlier pair. That is exact: before a pair of rank r
is due, what happens further away can only reach it through one growing piece, and no piece is longer than
``reach``. Runs of one character whose pieces all have the same rank (blanks) are cut where the leftmost
rule cuts them anyway, so a run of a million blanks is not a million rounds.

A null or empty text has no ids. Nothing depends on other rows, so repeated rows, ties and empty tables
need no rule; a very long text is cut at word starts, worked off in slices and put together again.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcdc.llm.common import Ragged, numbered, numbering, segment_sums

#: How a blank is written inside pieces, and what an unknown id decodes to.
BLANK = "▁"
UNKNOWN_TEXT = " ⁇ "
#: Characters that are laid out together.
SLICE = 250_000
#: Characters of text that are cut into words together.
STEP = 1_000_000
#: Characters of words that a task remembers before it starts afresh.
KNOWN_CHARACTERS = 4_000_000
_WORD = re.compile(f"[ {BLANK}]+[^ {BLANK}]*")
_NONE = np.int64(1) << 31
_LAST = np.int64((1 << 63) - 1)
_PLACE = (np.int64(1) << 32) - 1
_FREE = np.int64(-1)


class Pairs:
    """Ranks of pairs of ids: an open-addressing table that is asked with whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(left) * 8).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, _FREE)
        self.values = np.full(1 << bits, _NONE, np.int64)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at, open_ = self._home(keys), np.arange(len(keys))
        while len(open_):
            places, first = np.unique(at[open_], return_index=True)
            free = self.keys[places] == _FREE
            taken = open_[first[free]]
            self.keys[places[free]], self.values[places[free]] = keys[taken], values[taken]
            open_ = np.setdiff1d(open_, taken, assume_unique=True)
            at[open_] = (at[open_] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = self._home(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], _NONE)
        open_ = np.flatnonzero((held != keys) & (held != _FREE))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            held = self.keys[at[open_]]
            found = held == keys[open_]
            out[open_[found]] = self.values[at[open_[found]]]
            open_ = open_[~found & (held != _FREE)]
        return out


class Model:
    """What a BPE model file says: pieces, the order of merges, byte pieces."""

    def __init__(self, path: str):
        spec = sentencepiece.SentencePieceProcessor(model_file=path)
        if spec.normalize("Ａ  b ") != f"{BLANK}Ａ{BLANK}{BLANK}b{BLANK}":
            raise ValueError("only models without a normaliser, with a blank put in front")
        ids = range(spec.vocab_size())
        self.pieces = [spec.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (spec.is_byte(i) or spec.is_control(i) or spec.is_unknown(i) or spec.is_unused(i))]
        self.plain = {self.pieces[i]: i for i in plain}
        self.first_byte = spec.piece_to_id("<0x00>")
        if [spec.piece_to_id(f"<0x{b:02X}>") for b in range(256)] != list(range(self.first_byte, self.first_byte + 256)):
            raise ValueError("only models with byte pieces in order")
        if any(c not in self.plain for piece in self.plain for c in piece):
            raise ValueError("a piece holds a character that is no piece")
        #: Text of every id, as bytes; a control id has none.
        self.texts = [b""] * len(ids)
        for i in ids:
            if spec.is_byte(i):
                self.texts[i] = bytes([i - self.first_byte])
            elif spec.is_unknown(i):
                self.texts[i] = UNKNOWN_TEXT.encode()
            elif not spec.is_control(i):
                self.texts[i] = self.pieces[i].replace(BLANK, " ").encode()
        self.is_byte = [spec.is_byte(i) for i in ids]
        self.starts_blank = [not self.is_byte[i] and not spec.is_unknown(i) and text.startswith(b" ") for i, text in enumerate(self.texts)]
        self.reach = max(map(len, self.plain))
        self.char = np.full(0x110000, -1, np.int32)
        for piece, i in self.plain.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        self.char[0x20] = self.char[ord(BLANK)]
        self._read_merges(spec)
        self._read_borders()
        self.run = self._length_of_run(BLANK)

    def _read_merges(self, spec) -> None:
        """A pair of pieces can be merged if its text is a piece; a better score comes first, equal ones from the left."""
        order = {s: r for r, s in enumerate(sorted({spec.get_score(i) for i in self.plain.values()}, reverse=True))}
        found = [
            (self.plain[piece[:k]], self.plain[piece[k:]], order[spec.get_score(i)], i)
            for piece, i in self.plain.items()
            for k in range(1, len(piece))
            if piece[:k] in self.plain and piece[k:] in self.plain
        ]
        left, right, rank, made = (np.array(c, np.int64) for c in zip(*found))
        if int(rank.max()) >= (1 << 15) - 1 or len(self.pieces) > 1 << 16:
            raise ValueError("more pieces than this layout of ranks holds")
        # Rank and result travel as one number; several results may share a rank.
        self.ranks = Pairs(left, right, rank << 16 | made)

    def _read_borders(self) -> None:
        """Pairs of characters that stand side by side in some piece."""
        inner = {(self.plain[a], self.plain[b]) for piece in self.plain for a, b in zip(piece, piece[1:])}
        left, right = (np.array(c, np.int64) for c in zip(*inner))
        self.inner = Pairs(left, right, np.zeros(len(left), np.int64))

    def _length_of_run(self, c: str) -> int:
        """How many of ``c`` the first piece of a long run takes, 0 if runs cannot be cut.

        They can if pieces with two of ``c`` side by side hold nothing else, and all have one rank behind all others."""
        own = [p for p in self.plain if c + c in p]
        if not own or any(set(p) != {c} for p in own):
            return 0
        sizes = {len(p) for p in own} | {1}
        whole = [self.plain[c]] * (4 * self.reach)
        values = {int(v) >> 16 for v in self._values_of(own)}
        if len(values) != 1 or min(values) < int(self.ranks.values[self.ranks.keys != _FREE].max()) >> 16:
            return 0
        lengths = [len(self.pieces[i]) for i in merge_one(self, whole)]
        step = lengths[0]
        return step if step in sizes and lengths[:2] == [step, step] else 0

    def _values_of(self, pieces: Sequence[str]) -> np.ndarray:
        pairs = [(self.plain[p[:k]], self.plain[p[k:]]) for p in pieces for k in range(1, len(p)) if p[:k] in self.plain and p[k:] in self.plain]
        left, right = (np.array(x, np.int64) for x in zip(*pairs))
        return self.ranks.get(left, right)


def merge_one(model: Model, symbols: Sequence[int]) -> list[int]:
    """One word, one merge at a time, by a heap. The plain form of the rounds: for the layout of runs and for tests."""
    sym, n = list(symbols), len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    size = [1] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        value = int(model.ranks.get(np.array([sym[i]]), np.array([sym[j]]))[0])
        if value < _NONE:
            heapq.heappush(heap, (value >> 16, i, size[i] + size[j], value & 0xFFFF))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, length, made = heapq.heappop(heap)
        j = after[i]
        if sym[i] < 0 or j >= n or size[i] + size[j] != length:
            continue
        sym[i], sym[j], size[i] = made, -1, length
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            offer(i, after[i])
        if before[i] >= 0:
            offer(before[i], i)
    return [s for s in sym if s >= 0]


def merged(model: Model, sym: np.ndarray, pairs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols after all merges, at the places of their first characters; -1 at the others.

    ``pairs`` are the values of each symbol with its next one, ``first`` says where a word starts."""
    out = sym.copy()
    place = np.arange(len(sym), dtype=np.int64)
    # Rank, place and result as one number: the least of a word is its leftmost pair of the least rank.
    pairs = np.where(pairs == _NONE, _LAST, (pairs >> 16) << 48 | place << 16 | pairs & 0xFFFF)
    pairs[:-1][first[1:]] = _LAST
    pairs[-1:] = _LAST
    sym = sym.astype(np.int64)
    while len(sym):
        starts = np.flatnonzero(first)
        lengths = np.diff(np.append(starts, len(sym)))
        if int(lengths.max()) > 2 * model.reach:
            parts = np.where(lengths > 2 * model.reach, -(-lengths // model.reach), 1)
            word = np.repeat(np.arange(len(starts)), parts)
            nth = np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts)
            least = np.minimum.reduceat(pairs, starts[word] + nth * model.reach)
            open_ = np.bincount(word[least < _LAST], minlength=len(starts)) > 0
            rank, same = least >> 48, word[1:] == word[:-1]
            least[1:][same & (rank[:-1] <= rank[1:])] = _LAST
            least[:-1][same & (rank[1:] < rank[:-1])] = _LAST
        else:
            least = np.minimum.reduceat(pairs, starts)
            open_ = least < _LAST
        due = least[least < _LAST]
        p = np.searchsorted(place, due >> 16 & _PLACE)
        sym[p] = due & 0xFFFF
        out[place[p + 1]] = -1
        keep = np.ones(len(sym), bool)
        keep[p + 1] = False
        if not open_.all():
            # Words without a pair leave.
            gone = np.repeat(~open_, lengths)
            out[place[gone]] = sym[gone]
            keep &= ~gone
        p = (np.cumsum(keep, dtype=np.int64) - 1)[p]
        sym, pairs, place, first = sym[keep], pairs[keep], place[keep], first[keep]
        pairs[p] = _LAST
        inside = p[p + 1 < len(sym)]
        fresh = np.concatenate([p[~first[p]] - 1, inside[~first[inside + 1]]])
        value = model.ranks.get(sym[fresh], sym[fresh + 1])
        pairs[fresh] = np.where(value == _NONE, _LAST, (value >> 16) << 48 | place[fresh] << 16 | value & 0xFFFF)
    return out


class Encoder:
    """Encodes texts; words that were met before are remembered, up to ``limit`` characters of them."""

    def __init__(self, model: Model, limit: int = KNOWN_CHARACTERS):
        self.model, self.limit = model, limit
        self._forget()

    def _forget(self) -> None:
        self.words, self.lists, self.known = numbering(), Ragged(), 0

    def _flat(self, joined: str, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a joined text, and the place of the character each belongs to; ``heads`` starts every part."""
        model = self.model
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sym = model.char[codes]
        pairs = np.full(len(sym), _NONE, np.int64)
        pairs[:-1] = model.ranks.get(sym[:-1], sym[1:])
        # What is a piece by itself holds its two characters side by side; the others are looked up.
        ask = np.flatnonzero((pairs == _NONE)[:-1])
        apart = ask[model.inner.get(sym[ask], sym[ask + 1]) == _NONE] + 1
        first = np.zeros(len(sym), bool)
        first[apart] = True
        first[heads] = True
        if model.run:
            self._cut_runs(sym, first)
        unknown = np.flatnonzero(sym < 0)
        out = merged(model, sym, pairs, first)
        places = np.flatnonzero(out >= 0)
        ids = out[places]
        if len(unknown):
            raw = [chr(c).encode() for c in codes[unknown].tolist()]
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            extra = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) + model.first_byte
            places = np.concatenate([places, np.repeat(unknown, sizes)])
            order = np.argsort(places, kind="stable")
            ids, places = np.concatenate([ids, extra])[order], places[order]
        return ids, places

    def _cut_runs(self, sym: np.ndarray, first: np.ndarray) -> None:
        """Marks where long runs of blanks fall into pieces; the end of a run stays whole, as its last
        blank may belong to what follows."""
        blank = sym == self.model.char[0x20]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], blank, [False]]).view(np.int8)))
        begins, ends = edge[::2], edge[1::2]
        step = self.model.run
        many = ends - begins > 4 * step
        for begin, end in zip(begins[many].tolist(), ends[many].tolist()):
            heads = np.flatnonzero(first[begin:end]) + begin
            for low, high in zip([*heads.tolist()], [*heads.tolist()[1:], end]):
                first[low : high - 2 * step : step] = True

    def _learn(self) -> None:
        """Encodes the words that were numbered since the last time, slice by slice."""
        new = list(itertools.islice(reversed(self.words), len(self.words) - self.lists.count))[::-1]
        at = 0
        while at < len(new):
            size, end = 0, at
            while end < len(new) and size < SLICE:
                size += len(new[end]) + 1
                end += 1
            lengths = np.fromiter(map(len, new[at:end]), np.int64, end - at) + 1
            heads = np.cumsum(lengths) - lengths
            ids, places = self._flat(BLANK + BLANK.join(new[at:end]), heads)
            self.lists.add(ids, np.diff(np.append(np.searchsorted(places, heads), len(ids))))
            self.known += size
            at = end

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has."""
        if self.known > self.limit:
            self._forget()
        flat, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        parts, owners, size = [], [], 0

        def work() -> None:
            split = [_words(part) for part in parts]
            at = numbered(self.words, itertools.chain.from_iterable(split))
            self._learn()
            ids, lengths = self.lists.gather(at)
            flat.append(ids)
            np.add.at(counts, owners, segment_sums(lengths, np.fromiter(map(len, split), np.int64, len(split))))

        for owner, text in enumerate(texts):
            for part in _cut(text) if text else ():
                parts.append(part)
                owners.append(owner)
                size += len(part)
                if size >= STEP:
                    work()
                    parts, owners, size = [], [], 0
        if parts:
            work()
        return np.concatenate(flat), counts


def _cut(text: str) -> Iterator[str]:
    """A long text in parts that end where a blank follows something else; that blank is left out."""
    at = 0
    while len(text) - at > STEP:
        cut = at + STEP
        while (cut := text.find(" ", cut)) >= 0 and text[cut - 1] in (" ", BLANK):
            cut += 1
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def _words(text: str) -> list[str]:
    """A text as words, each without the blank it starts with. Further blanks stay with the word they stand before."""
    if "  " in text or BLANK in text or text[:1] in ("", " ") or text[-1] == " ":
        return [word[1:] for word in _WORD.findall(BLANK + text)]
    return text.split(" ")


def decode_ids(model: Model, ids: Sequence[int]) -> str:
    """Text of the ids; bytes that are no UTF-8 become one replacement character each."""
    raw = b"".join(map(model.texts.__getitem__, ids))
    head = next((i for i in ids if model.texts[i]), None)
    skip = 1 if head is not None and model.starts_blank[head] else 0
    try:
        return raw[skip:].decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, held = [], b""
    for i in ids:
        if model.is_byte[i]:
            held += model.texts[i]
            continue
        out += [_characters(held), model.texts[i].decode("utf-8")]
        held = b""
    return "".join([*out, _characters(held)])[skip:]


def _characters(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about a step of bytes each."""
    size, start = 0, 0
    for at, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        size += n
        if size >= STEP:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds ``ids`` (array of int) and, if it is named, ``decoded``: what these ids decode to. Columns of
    those names are replaced. No shuffle; each task reads the model file at ``path``, which must be on
    every executor."""
    kept = [c for c in df.columns if c not in (ids, decoded)]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    fields = [rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("decoded", T.StringType())] if decoded else []
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(path)
        encoder = Encoder(model)
        for batch in batches:
            for start, end in _slices(batch.column(1)):
                texts = batch.column(1).slice(start, end - start).to_pylist()
                flat, counts = encoder.encode(texts)
                ends = np.concatenate([[0], np.cumsum(counts)])
                columns = [batch.column(0).slice(start, end - start), pa.ListArray.from_arrays(ends.astype(np.int32), flat)]
                if decoded:
                    plain, at = flat.tolist(), ends.tolist()
                    columns.append(pa.array([decode_ids(model, plain[a:b]) for a, b in zip(at, at[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    done = rows.mapInArrow(run, T.StructType(fields))
    return done.select("row.*", F.col("ids").alias(ids), *([F.col("decoded").alias(decoded)] if decoded else []))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds ``text``, what the ids stand for, replacing a column of that name. Null ids are no ids."""
    kept = [c for c in df.columns if c != text]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{ids}`").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(path)
        for batch in batches:
            texts = [decode_ids(model, found or []) for found in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    done = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))
    return done.select("row.*", F.col("text").alias(text))
