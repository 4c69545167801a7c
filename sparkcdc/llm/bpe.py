"""BPE encoding by a pair occurrence index, and decoding.

The words of a partition that were not met before are laid out as one sequence of symbols. An index
maps every pair that has a rank to all its positions. Ranks that occur are taken in ascending order
from a heap; a rank's positions are merged together, left to right, and the pairs that arise at their
borders are added to the lists of their own ranks. A merge only ever creates pairs of a later rank
(checked when the tokenizer file is read), so each rank is applied once per partition.

Texts are cut at spaces between two non-spaces, where a word of the byte-level pattern always starts;
what lies between is looked up in a bounded table of known pieces.

A null text encodes as the empty one. Nothing depends on other rows, so repeated rows, ties and empty
tables need no rule; a very long text is one row of symbols like any other.
"""

from __future__ import annotations

import gc
import heapq
import itertools
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcdc.llm.common import Ragged, numbered, numbering, segment_sums

#: Fixed value: the word pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A place where a word always starts: a space between two characters that are no white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Pieces, and words, remembered by a task before it starts afresh.
KNOWN_PIECES = 1 << 18
_NONE = np.int32(1 << 30)


def byte_characters() -> dict[int, str]:
    """Byte-level files write a byte as a printable character: itself, or the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Tokenizer:
    """What a byte-level BPE file says: tokens, ranked pairs and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        bytes_of = {c: b for b, c in byte_characters().items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.pieces = [b""] * size
        for token, i in vocab.items():
            self.pieces[i] = bytes(bytes_of[c] for c in token)
        for token, i in self.special.items():
            self.pieces[i] = token.encode()
        self.first = np.zeros(256, np.int32)
        for b, c in byte_characters().items():
            self.first[b] = vocab[c]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.left, self.right = left.astype(np.int32), right.astype(np.int32)
        born = np.full(size, -1, np.int64)
        born[self.made] = np.arange(len(merges))
        if (np.maximum(born[left], born[right]) >= np.arange(len(merges))).any() or len(set(self.made.tolist())) != len(merges):
            raise ValueError("a merge uses a token that a later merge makes; ranks cannot be applied in one pass")
        self.size = size
        keys = left * size + right
        self.key_order = np.argsort(keys)
        self.keys = keys[self.key_order]
        self.splitter = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(PATTERN)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where there is none."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_order[at], _NONE).astype(np.int32)

    def encode_flat(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array and how many each has, by one pair occurrence index over all of them."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), lengths
        sym = self.first[data]
        starts = np.cumsum(lengths) - lengths
        after = np.arange(1, n + 1, dtype=np.int32)
        after[np.cumsum(lengths)[lengths > 0] - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[starts[lengths > 0]] = -1
        self._apply(sym, before, after)
        left = sym >= 0
        return sym[left], segment_sums(left, lengths)

    def encode_words(self, words: Sequence[bytes]) -> list[tuple[int, ...]]:
        """Ids of each word."""
        flat, lengths = self.encode_flat(words)
        ends = np.cumsum(lengths).tolist()
        ids = flat.tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends)]

    def _apply(self, sym: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
        """Merges in place; a position that is merged into the one before it becomes -1."""
        inner = np.flatnonzero(after >= 0)
        rank = self.ranks(sym[inner], sym[inner + 1])
        inner, rank = inner[rank < _NONE], rank[rank < _NONE]
        order = np.argsort(rank, kind="stable")
        inner, rank = inner[order].astype(np.int32), rank[order]
        active, cuts = np.unique(rank, return_index=True)
        lists: dict[int, list[np.ndarray]] = {r: [part] for r, part in zip(active.tolist(), np.split(inner, cuts[1:]))}
        heap = active.tolist()
        while heap:
            r = heapq.heappop(heap)
            parts = lists.pop(r)
            a, b, made = self.left[r], self.right[r], self.made[r]
            p = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            q = after[p]
            # A list may hold positions that an earlier rank has changed.
            valid = (sym[p] == a) & (q >= 0) & (sym[q] == b)
            if not valid.all():
                p, q = p[valid], q[valid]
                if not len(p):
                    continue
            if a == b and len(p) > 1:
                # In a run of equal symbols every other pair is merged, from the left.
                chained = np.concatenate([[False], q[:-1] == p[1:]])
                place = np.arange(len(p))
                run_start = np.maximum.accumulate(np.where(chained, 0, place))
                keep = (place - run_start) % 2 == 0
                p, q = p[keep], q[keep]
            beyond = after[q]
            sym[p] = made
            sym[q] = -1
            after[p] = beyond
            inside = beyond >= 0
            before[beyond[inside]] = p[inside]
            ahead = before[p]
            fresh = np.concatenate([ahead[ahead >= 0], p[inside]])
            if not len(fresh):
                continue
            got = self.ranks(sym[fresh], sym[after[fresh]])
            known = got < _NONE
            if not known.any():
                continue
            fresh, got = fresh[known], got[known]
            if len(got) > 1:
                order = np.lexsort((fresh, got))
                fresh, got = fresh[order], got[order]
                cuts = np.flatnonzero(got[1:] != got[:-1]) + 1
                names, chunks = got[np.concatenate([[0], cuts])].tolist(), np.split(fresh, cuts)
            else:
                names, chunks = got.tolist(), [fresh]
            for name, chunk in zip(names, chunks):
                held = lists.get(name)
                if held is None:
                    # Parts are made unique when they are joined; a single part may repeat a position.
                    lists[name] = [chunk, chunk[:0]]
                    heapq.heappush(heap, name)
                else:
                    held.append(chunk)


class Encoder:
    """Encodes batches of texts. Pieces and words are numbered as they are met; new ones are encoded together,
    and texts are put together from their numbers. Each memory starts afresh beyond ``limit`` entries."""

    def __init__(self, tokenizer: Tokenizer, limit: int = KNOWN_PIECES):
        self.tokenizer, self.limit = tokenizer, limit
        self._forget_pieces()
        self._forget_words()

    def _forget_pieces(self) -> None:
        # A piece that starts a stretch of text is kept apart, as a tuple, from one that follows a blank.
        self.pieces, self.piece_ids = numbering(), Ragged()
        self.uncut = np.zeros(1 << 10, bool)

    def _forget_words(self) -> None:
        self.words, self.word_ids = numbering(), Ragged()
        # The string of a special token is never a word of the pattern, so it can be kept among the words.
        special = self.tokenizer.special
        numbered(self.words, special)
        self.word_ids.add(np.array([*special.values()], np.int32), np.ones(len(special), np.int64))

    def _learn(self) -> None:
        """Encodes the pieces that were numbered since the last time: their new words first, by the index."""
        known = self.piece_ids.count
        new = list(itertools.islice(reversed(self.pieces), len(self.pieces) - known))[::-1]
        if not new:
            return
        if len(self.words) > self.limit:
            self._forget_words()
        find = self.tokenizer.words.findall
        cut = [find(" " + piece) if isinstance(piece, str) else find(piece[0]) if len(piece) == 1 else piece[:1] for piece in new]
        at = numbered(self.words, itertools.chain.from_iterable(cut))
        fresh = list(itertools.islice(reversed(self.words), len(self.words) - self.word_ids.count))[::-1]
        self.word_ids.add(*self.tokenizer.encode_flat([w.encode("utf-8", "surrogatepass") for w in fresh]))
        ids, lengths = self.word_ids.gather(at)
        self.piece_ids.add(ids, segment_sums(lengths, np.fromiter(map(len, cut), np.int64, len(cut))))
        if len(self.uncut) < len(self.pieces):
            self.uncut = np.concatenate([self.uncut, np.zeros(len(self.pieces), bool)])
        # Next to white space a blank is part of a longer word: such a text is cut with more care.
        inner = (piece if isinstance(piece, str) else piece[0] for piece in new)
        self.uncut[known : len(self.pieces)] = [not p or p[0].isspace() or p[-1].isspace() for p in inner]

    def _cut_plainly(self, text: str, blank: bool) -> list:
        """Pieces between blanks; one empty piece, which sends the text on, where a special token may be."""
        if any(s in text for s in self.tokenizer.special):
            return [("",)]
        pieces = text.split(" ")
        if not blank:
            pieces[0] = (pieces[0],)
        return pieces

    def _cut_with_care(self, text: str, blank: bool) -> list:
        """Pieces between blanks that have no white space beside them, and special tokens, as pairs."""
        special, splitter = self.tokenizer.special, self.tokenizer.splitter
        text = " " + text if blank else text
        pieces = []
        for part in splitter.split(text) if splitter and any(s in text for s in special) else [text]:
            if part in special:
                pieces.append((part, None))
            elif part:
                head, *rest = _CUT.split(part)
                pieces += [(head,), *rest]
        return pieces

    def _put_together(self, cut: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        at = numbered(self.pieces, itertools.chain.from_iterable(cut))
        self._learn()
        ids, lengths = self.piece_ids.gather(at)
        return ids, segment_sums(lengths, sizes), segment_sums(self.uncut[at], sizes)

    def encode_flat(self, texts: Sequence[str | None], blank: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has; with ``blank``, of texts that have one put in front."""
        if len(self.pieces) > self.limit:
            self._forget_pieces()
        # Many small strings and lists arise at once, none in a cycle: the collector would only walk them.
        collecting = gc.isenabled()
        gc.disable()
        try:
            ids, counts, uncut = self._put_together([self._cut_plainly(text, blank) if text else () for text in texts])
            odd = np.flatnonzero(uncut)
            if len(odd):
                more, sizes, _ = self._put_together([self._cut_with_care(texts[k], blank) for k in odd.tolist()])
                both = Ragged()
                both.add(ids, counts)
                both.add(more, sizes)
                place = np.arange(len(texts))
                place[odd] = len(texts) + np.arange(len(odd))
                ids, counts = both.gather(place)
            return ids, counts
        finally:
            if collecting:
                gc.enable()

    def encode(self, texts: Sequence[str | None]) -> list[list[int]]:
        flat, counts = self.encode_flat(texts)
        ends, ids = np.cumsum(counts).tolist(), flat.tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


def decode_ids(tokenizer: Tokenizer, ids: Sequence[int]) -> str:
    """Text of the ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(tokenizer.pieces.__getitem__, ids)).decode("utf-8", "replace")


#: Bytes of text that are encoded together, and whose ids are handed over together. A lesson's pieces and its symbol
#: arrays are a task's peak of memory.
_LESSON = 2_000_000
_SLICE = 1_000_000


def _slices(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    size, start = 0, 0
    for at, n in enumerate(sizes):
        size += n
        if size >= most:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None,
           limit: int = KNOWN_PIECES) -> DataFrame:
    """Adds ``ids`` (array of int) and, if it is named, ``decoded``: what these ids decode to. Columns of
    those names are replaced. No shuffle; each task reads the tokenizer file at ``path``, which must be
    on every executor. A task remembers about ``limit`` pieces, and words; ids do not depend on it."""
    kept = [c for c in df.columns if c not in (ids, decoded)]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    fields = [rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("decoded", T.StringType())] if decoded else []
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(path)
        encoder = Encoder(tokenizer, limit)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for low, high in _slices(sizes, _LESSON):
                flat, counts = encoder.encode_flat(batch.column(1).slice(low, high - low).to_pylist())
                ends = np.concatenate([[0], np.cumsum(counts)])
                for start, end in _slices(sizes[low:high], _SLICE):
                    part, at = flat[ends[start] : ends[end]], ends[start : end + 1] - ends[start]
                    columns = [batch.column(0).slice(low + start, end - start), pa.ListArray.from_arrays(at.astype(np.int32), part)]
                    if decoded:
                        plain, at = part.tolist(), at.tolist()
                        columns.append(pa.array([decode_ids(tokenizer, plain[a:b]) for a, b in zip(at, at[1:])], pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names)
                # Texts differ in length by orders: what a large batch took is handed back, not kept for the next one.
                pa.default_memory_pool().release_unused()

    done = rows.mapInArrow(run, T.StructType(fields))
    return done.select("row.*", F.col("ids").alias(ids), *([F.col("decoded").alias(decoded)] if decoded else []))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds ``text``, what the ids stand for, replacing a column of that name. Null ids are no ids."""
    kept = [c for c in df.columns if c != text]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{ids}`").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(path)
        for batch in batches:
            lists = batch.column(1)
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
            there = lists.is_valid().to_pylist()
            texts = [decode_ids(tokenizer, flat[a:b].tolist()) if ok else "" for a, b, ok in zip(ends, ends[1:], there)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    done = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("text", T.StringType())]))
    return done.select("row.*", F.col("text").alias(text))
