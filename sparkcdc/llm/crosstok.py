"""Alignment of two tokenizers over a corpus, by external spill counting.

Token ends that fall together cut a text into groups; the two tokens that end there are a link. How often
an id pair is linked in the whole corpus is counted outside memory:

1. A task aligns a batch of texts and turns its links into pair-document records. Records are radix-partitioned
   by the B id, sorted (B id, A id, document) and written as zstd runs, one per batch and radix.
2. A radix's runs are merged k ways under a heap of block ends, ``FAN`` at a time, and the counts of equal pairs
   added up. The order is B-major, so an id's highest count is known as soon as its pairs have gone by.
3. The counts go back to the runs of their radix, each run's records are streamed past them, and what they
   contribute to its batch's documents is added up there.

No record of another batch is ever in memory with them. Pairs are added up per batch before anything is shuffled, so
a pair that every document holds costs a batch one entry; the runs of one radix are dealt to several tasks
by their size. The number of radices follows the size of the texts.

A null or empty text, and one whose tokens do not give it back byte for byte, has no tokens: its counts are 0
and its groups are empty. Repeated rows count as often as they come; ids may be null or repeated, since rows
are told apart by batch and place. The text column is left out of the result; columns named like a result are replaced.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcdc.llm import bpe, pieces
from sparkcdc.llm.common import Ragged, numbered, numbering, segment_sums, written

#: Bytes of text, and documents, of a batch.
BATCH_BYTES, BATCH_ROWS = 2_000_000, 1 << 16
#: Pieces remembered by a task before it starts afresh.
KNOWN_PIECES = 1 << 18
#: Pairs of a block, blocks merged at a time, pairs of a row of counts.
BLOCK, FAN, ROW = 4096, 64, 1 << 16
#: Bytes of text per radix, the least number of radices, and bytes of runs one task reads with one radix's counts.
RADIX_BYTES, LEAST_RADICES, SHARE_BYTES = 1 << 26, 64, 1 << 25
#: Bits of an id on each side, and what spreads B ids over radices (odd, so it can be undone).
B_BITS, A_BITS, SPREAD = 16, 17, 0x9E3D
RESULTS = ("n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum")


class Aligner:
    """Tokens of both sides and the groups they form.

    Both tokenizers start a token at a blank between two characters that are no white space, so what lies between two
    such blanks is aligned by itself, once, and remembered; beyond ``limit`` pieces the memory starts afresh."""

    def __init__(self, path_a: str, path_b: str, limit: int = KNOWN_PIECES):
        self.a = bpe.Tokenizer(path_a)
        # Strings of special tokens inside texts are plain text here.
        self.a.special, self.a.splitter = {}, None
        self.b = pieces.Model(path_b)
        self.encode_a, self.encode_b = bpe.Encoder(self.a, limit // 4), pieces.Encoder(self.b, 2 * limit)
        if len(self.a.pieces) > 1 << A_BITS or len(self.b.texts) > 1 << B_BITS:
            raise ValueError("more ids than a record holds")
        self.bytes_a = np.fromiter(map(len, self.a.pieces), np.int64)
        self.bytes_b = np.fromiter(map(len, self.b.texts), np.int64)
        self.shown = [f"{i}{end}" for i in range(len(self.a.pieces)) for end in ",|"]
        self.shown += [f"{i}{end}" for i in range(len(self.b.texts)) for end in (",", ";", "\n")]
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.known, self.texts = numbering(), []
        self.links, self.sizes = Ragged(np.int64), [Ragged(np.int64) for _ in range(3)]
        self.apart = Ragged(bool)

    def _learn(self) -> None:
        new = list(itertools.islice(reversed(self.known), len(self.known) - len(self.texts)))[::-1]
        n_a, n_b, n_groups, groups, a, b, _ = self.aligned(new)
        self.texts += groups
        self.links.add(b.astype(np.int64) << A_BITS | a, n_groups)
        one = np.ones(len(new), np.int64)
        for held, found in zip(self.sizes, (n_a, n_b, n_groups)):
            held.add(found, one)
        # Next to white space a blank belongs to a longer token; and a piece may not be given back.
        self.apart.add(np.array([not p or p[0].isspace() or p[-1].isspace() or pieces.BLANK in p for p in new], bool) | (n_groups == 0), one)

    def align(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text its tokens on both sides, groups and their text; per link its A id, B id and text."""
        if len(self.known) > self.limit:
            self._forget()
        cut = [text.split(" ") if text else [] for text in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        at = numbered(self.known, itertools.chain.from_iterable(cut))
        del cut
        self._learn()
        odd = segment_sums(self.apart.gather(at)[0], sizes) > 0
        at, sizes = at[np.repeat(~odd, sizes)], np.where(odd, 0, sizes)
        facts = [segment_sums(held.gather(at)[0], sizes) for held in self.sizes]
        links, per_piece = self.links.gather(at)
        owner = np.repeat(np.arange(len(texts)), segment_sums(per_piece, sizes))
        shown, low = [], 0
        for size in sizes.tolist():
            shown.append(";".join(map(self.texts.__getitem__, at[low : low + size].tolist())))
            low += size
        a, b = links & ((1 << A_BITS) - 1), links >> A_BITS
        if odd.any():
            where = np.flatnonzero(odd)
            *more, groups, more_a, more_b, linked = self.aligned([texts[k] for k in where.tolist()])
            for held, found in zip(facts, more):
                held[where] = found
            for k, text in zip(where.tolist(), groups):
                shown[k] = text
            a, b, owner = np.concatenate([a, more_a]), np.concatenate([b, more_b]), np.concatenate([owner, where[linked]])
        return *facts, shown, a, b, owner

    def aligned(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The same without remembering."""
        whole = [" " + text if text else None for text in texts]
        ids_a, n_a = self.encode_a.encode_flat(texts, blank=True)
        ids_b, n_b = self.encode_b.encode(texts)
        kept = self._kept(whole, ids_a, n_a, ids_b, n_b)
        if not kept.all():
            ids_a, ids_b = ids_a[np.repeat(kept, n_a)], ids_b[np.repeat(kept, n_b)]
            n_a, n_b = n_a * kept, n_b * kept
        # Both sides have the same bytes in the same texts, so ends can be compared over all of them.
        ends_a, ends_b = np.cumsum(self.bytes_a[ids_a]), np.cumsum(self.bytes_b[ids_b])
        at = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, bool)
        at[ends_a] = True
        last_b = at[ends_b]
        at[:] = False
        at[ends_b] = True
        last_a = at[ends_a]
        owner_a = np.repeat(np.arange(len(texts)), n_a)
        linked = owner_a[last_a]
        n_groups = np.bincount(linked, minlength=len(texts))
        return n_a, n_b, n_groups, self._groups(ids_a, ids_b, last_a, last_b, n_a, n_b), ids_a[last_a], ids_b[last_b], linked

    def _kept(self, whole, ids_a, n_a, ids_b, n_b) -> np.ndarray:
        """Which texts both sides give back."""
        there = [text.encode() for text in whole if text is not None]
        raw, lengths = b"".join(there), np.fromiter(map(len, there), np.int64, len(there))
        kept = np.array([text is not None for text in whole], bool)
        if all(
            np.array_equal(segment_sums(size[ids], n)[kept], lengths) and b"".join(map(texts.__getitem__, ids.tolist())) == raw
            for ids, n, size, texts in ((ids_a, n_a, self.bytes_a, self.a.pieces), (ids_b, n_b, self.bytes_b, self.b.texts))
        ):
            return kept
        low_a = low_b = 0
        for k, (text, a, b) in enumerate(zip(whole, n_a.tolist(), n_b.tolist())):
            if text is not None:
                raw = text.encode()
                kept[k] = (
                    b"".join(map(self.b.texts.__getitem__, ids_b[low_b : low_b + b].tolist())) == raw
                    and b"".join(map(self.a.pieces.__getitem__, ids_a[low_a : low_a + a].tolist())) == raw
                )
            low_a, low_b = low_a + a, low_b + b
        return kept

    def _groups(self, ids_a, ids_b, last_a, last_b, n_a, n_b) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per text: tokens and the mark after each are looked up together."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        groups = int(last_a.sum())
        upto_a = np.concatenate([[0], np.cumsum(np.bincount(group_a, minlength=groups))])
        upto_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=groups))])
        final = np.zeros(len(ids_b), bool)
        ends_b = np.cumsum(n_b)
        final[ends_b[n_b > 0] - 1] = True
        words = np.empty(len(ids_a) + len(ids_b), np.int64)
        words[np.arange(len(ids_a)) + upto_b[group_a]] = ids_a.astype(np.int64) * 2 + last_a
        words[np.arange(len(ids_b)) + upto_a[group_b + 1]] = len(self.a.pieces) * 2 + ids_b.astype(np.int64) * 3 + last_b + final
        # One text over all, cut where the last token of each ends.
        shown = iter("".join(map(self.shown.__getitem__, words.tolist())).split("\n"))
        return [next(shown) if n else "" for n in n_a.tolist()]


def spread(b: np.ndarray) -> np.ndarray:
    """B ids in an order in which the leading bits, the radix, hold neighbours of the vocabulary apart."""
    return b.astype(np.int64) * SPREAD & ((1 << B_BITS) - 1)


def _packed(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def _column(raw: bytes, at: int, kind: str, n: int) -> tuple[np.ndarray, int]:
    size = np.dtype(kind).itemsize * n
    return np.frombuffer(raw, kind, n, at), at + size


def pack_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs and their counts as zstd blocks, each behind its size and number of pairs."""
    out = []
    for low in range(0, len(keys), BLOCK):
        part = keys[low : low + BLOCK]
        steps = np.diff(part, prepend=0)
        block = _packed(steps.astype(np.int64), counts[low : low + BLOCK].astype(np.int64))
        out += [np.array([len(block), len(part)], np.uint32).tobytes(), block]
    return b"".join(out)


def blocks_of(run: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The blocks of a run; one is unpacked at a time."""
    at, reader = 0, zstandard.ZstdDecompressor()
    while at < len(run):
        size, n = np.frombuffer(run, np.uint32, 2, at).tolist()
        raw = reader.decompress(run[at + 8 : at + 8 + size])
        steps, rest = _column(raw, 0, "<i8", n)
        yield np.cumsum(steps), _column(raw, rest, "<i8", n)[0]
        at += 8 + size


def merge_runs(runs: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of all runs in order, counts of equal pairs added up.

    Every run has one block open. The heap holds the last pair of each; up to the least of them all open
    blocks are complete, so that much is taken from each. More than ``FAN`` runs are merged to fewer first."""
    while len(runs) > FAN:
        runs = [b"".join(pack_run(*part) for part in merge_runs(runs[at : at + FAN])) for at in range(0, len(runs), FAN)]
    sources = [blocks_of(run) for run in runs]
    held = [next(source, None) for source in sources]
    heap = [(int(block[0][-1]), i) for i, block in enumerate(held) if block is not None]
    heapq.heapify(heap)
    while heap:
        bound = heap[0][0]
        taken = []
        for i in [i for _, i in heap]:
            keys, counts = held[i]
            cut = int(np.searchsorted(keys, bound, "right"))
            if cut:
                taken.append((keys[:cut], counts[:cut]))
                held[i] = keys[cut:], counts[cut:]
        while heap and heap[0][0] == bound:
            _, i = heapq.heappop(heap)
            held[i] = next(sources[i], None)
            if held[i] is not None:
                heapq.heappush(heap, (int(held[i][0][-1]), i))
        keys = np.concatenate([k for k, _ in taken])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in taken])[order]
        heads = np.flatnonzero(np.diff(keys, prepend=-1))
        yield keys[heads], np.add.reduceat(counts, heads)


def with_maxima(merged: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Adds whether a pair's count is the highest of its B id. The pairs of the last id are held back until
    the next one begins; an id has at most one pair with each A id."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def marked(keys, counts):
        heads = np.flatnonzero(np.diff(keys >> A_BITS, prepend=-1))
        top = np.maximum.reduceat(counts, heads)
        return keys, counts, counts == np.repeat(top, np.diff(np.append(heads, len(keys))))

    for more_keys, more_counts in merged:
        keys, counts = np.concatenate([keys, more_keys]), np.concatenate([counts, more_counts])
        open_ = int(np.searchsorted(keys, keys[-1] >> A_BITS << A_BITS))
        if open_ >= ROW:
            yield marked(keys[:open_], counts[:open_])
            keys, counts = keys[open_:], counts[open_:]
    if len(keys):
        yield marked(keys, counts)


def records(a: np.ndarray, b: np.ndarray, doc: np.ndarray, radix_bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """A batch's links as runs: per radix the pairs with their counts, and which documents hold each how often."""
    key = np.sort((spread(b) << A_BITS | a) << 16 | doc)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    found, n = key[first], np.diff(np.append(first, len(key)))
    pair = found >> 16
    heads = np.flatnonzero(np.diff(pair, prepend=-1))
    radix = pair[heads] >> (A_BITS + B_BITS - radix_bits)
    totals, held = np.add.reduceat(n, heads) if len(heads) else n, np.diff(np.append(heads, len(pair)))
    cuts = np.flatnonzero(np.diff(radix, prepend=-1))
    for low, high in zip(cuts.tolist(), [*cuts.tolist()[1:], len(heads)]):
        first, last = heads[low], heads[high] if high < len(heads) else len(pair)
        refs = _packed(held[low:high].astype("<u4"), found[first:last].astype("<u2"), n[first:last].astype("<u4"))
        yield int(radix[low]), pack_run(pair[heads[low:high]], totals[low:high]), refs


def contributions(pairs: bytes, refs: bytes, keys: np.ndarray, counts: np.ndarray, best: np.ndarray) -> bytes:
    """What a run adds to its batch: per document the links that are best and the sum of counts."""
    own = np.concatenate([k for k, _ in blocks_of(pairs)])
    raw = zstandard.ZstdDecompressor().decompress(refs)
    held, at = _column(raw, 0, "<u4", len(own))
    size = int(held.sum())
    doc, at = _column(raw, at, "<u2", size)
    n = _column(raw, at, "<u4", size)[0].astype(np.int64)
    place = np.repeat(np.searchsorted(keys, own), held)
    docs, where = np.unique(doc, return_inverse=True)
    out = np.zeros((2, len(docs)), np.int64)
    np.add.at(out[0], where, n * best[place])
    np.add.at(out[1], where, n * counts[place])
    return np.uint32(len(docs)).tobytes() + _packed(docs.astype("<u2"), out[0], out[1])


def _optional(row: T.StructField) -> T.StructField:
    """Rows of runs have no row of the input."""
    return T.StructField("row", T.StructType([T.StructField(f.name, f.dataType) for f in row.dataType.fields]))


def _null(kind: pa.DataType, n: int) -> pa.Array:
    return pa.nulls(n, kind)


def _aligned(df: DataFrame, path_a: str, path_b: str, text: str, radix_bits: int, shown: Callable[[Column], Column]) -> DataFrame:
    """Rows of two sorts: one per document (radix -1) and one per run."""
    kept = [c for c in df.columns if c not in RESULTS and c != text]
    rows = df.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    head = "batch bigint, place int, radix int, n_a bigint, n_b bigint, n_groups bigint, groups string, pairs binary, refs binary"
    schema = T.StructType([_optional(rows.schema["row"]), *T.StructType.fromDDL(head).fields])

    def work(aligner, batch, low, high, number) -> Iterator[pa.RecordBatch]:
        size = high - low
        n_a, n_b, n_groups, groups, a, b, doc = aligner.align(batch.column(1).slice(low, size).to_pylist())
        facts = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(low, size), pa.array(np.full(size, number)), pa.array(np.arange(size, dtype=np.int32)),
             pa.array(np.full(size, -1, np.int32)), *facts, pa.array(groups, pa.string()), _null(pa.binary(), size), _null(pa.binary(), size)],
            schema.names)
        runs = list(records(a, b, doc, radix_bits))
        n = len(runs)
        if n:
            radix, pairs, refs = zip(*runs)
            yield pa.RecordBatch.from_arrays(
                [_null(batch.column(0).type, n), pa.array(np.full(n, number)), _null(pa.int32(), n), pa.array(radix, pa.int32()),
                 *[_null(pa.int64(), n)] * 3, _null(pa.string(), n), pa.array(pairs, pa.binary()), pa.array(refs, pa.binary())],
                schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            size, low = 0, 0
            for at, more in enumerate([*sizes, None]):
                if low < at and (more is None or size >= BATCH_BYTES or at - low >= BATCH_ROWS):
                    yield from work(aligner, batch, low, at, number)
                    number, low, size = number + 1, at, 0
                size += more or 0

    groups = F.when(F.col("n_groups") > 0, shown(F.col("groups"))).otherwise(F.when(F.col("radix") < 0, F.lit("")))
    return rows.mapInArrow(run, schema).withColumn("groups", groups)


def _totals(runs: DataFrame) -> DataFrame:
    """Per radix, in rows of some ten thousand pairs: counts, and whether each is its B id's highest."""

    def count(radix: int, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        for keys, counts, best in with_maxima(merge_runs(blobs)):
            row = [[radix], [np.uint32(len(keys)).tobytes() + _packed(keys, counts, best)]]
            yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.binary())], ["radix", "counted"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blobs = None, []
        for batch in batches:
            for radix, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if radix != held and blobs:
                    yield from count(held, blobs)
                    blobs = []
                held = radix
                blobs.append(pairs)
        if blobs:
            yield from count(held, blobs)

    dealt = runs.select("radix", "pairs").repartition("radix").sortWithinPartitions("radix")
    return dealt.mapInArrow(merge, "radix int, counted binary")


def _counted(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.uint32, 1)[0])
    raw = zstandard.ZstdDecompressor().decompress(blob[4:])
    keys, at = _column(raw, 0, "<i8", n)
    counts, at = _column(raw, at, "<i8", n)
    return keys, counts, _column(raw, at, "?", n)[0]


def _streamed_back(runs: DataFrame, totals: DataFrame) -> DataFrame:
    """Every run past the counts of its radix. A radix with many bytes of runs is read by several tasks, each
    with a copy of its counts."""
    shares = runs.groupBy("radix").agg(F.ceil(F.sum(F.octet_length("refs")) / SHARE_BYTES).cast("int").alias("shares"))
    first = totals.join(shares, "radix").select(
        "radix", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(-1).cast("bigint").alias("batch"),
        "counted", F.lit(None).cast("binary").alias("pairs"), F.lit(None).cast("binary").alias("refs"),
    )
    share = F.pmod(F.xxhash64("batch"), F.col("shares").cast("bigint")).cast("int").alias("share")
    then = runs.join(shares, "radix").select("radix", share, "batch", F.lit(None).cast("binary").alias("counted"), "pairs", "refs")
    dealt = first.unionByName(then).repartition("radix", "share").sortWithinPartitions("radix", "share", "batch")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, known = None, [], None
        for batch in batches:
            numbers, blobs = [], []
            for row in batch.to_pylist():
                if (row["radix"], row["share"]) != here:
                    here, parts, known = (row["radix"], row["share"]), [], None
                if row["counted"] is not None:
                    parts.append(_counted(row["counted"]))
                    continue
                if known is None:
                    # Rows of counts may arrive in any order.
                    parts.sort(key=lambda part: int(part[0][0]))
                    known = [np.concatenate(column) for column in zip(*parts)]
                numbers.append(row["batch"])
                blobs.append(contributions(row["pairs"], row["refs"], *known))
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())], ["batch", "added"])

    return dealt.mapInArrow(stream, "batch bigint, added binary")


def _added_up(docs: DataFrame, added: DataFrame) -> DataFrame:
    """Documents with what all radices contributed to them."""
    row = docs.schema["row"].dataType
    columns = ["batch", "place", "row", "n_a", "n_b", "n_groups", "groups"]
    first = added.select("batch", F.lit(-1).alias("place"), F.lit(None).cast(row).alias("row"), *[F.lit(None).cast("bigint").alias(c) for c in columns[3:6]], F.lit(None).cast("string").alias("groups"), "added")
    dealt = docs.select(*columns, F.lit(None).cast("binary").alias("added")).unionByName(first)
    dealt = dealt.repartition("batch").sortWithinPartitions("batch", "place")
    schema = T.StructType([_optional(docs.schema["row"]), *T.StructType.fromDDL("n_a bigint, n_b bigint, n_groups bigint, groups string, n_links bigint, n_best bigint, count_sum bigint").fields])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sums = None, None
        for batch in batches:
            numbers, places = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out = np.zeros((2, len(numbers)), np.int64)
            heads = np.flatnonzero(np.diff(numbers, prepend=numbers[0] - 1)) if len(numbers) else np.zeros(0, np.int64)
            for low, high in zip(heads.tolist(), [*heads.tolist()[1:], len(numbers)]):
                if numbers[low] != here:
                    here, sums = numbers[low], np.zeros((2, BATCH_ROWS), np.int64)
                mid = low + int(np.searchsorted(places[low:high], 0))
                for blob in batch.column(7).slice(low, mid - low).to_pylist():
                    n = int(np.frombuffer(blob, np.uint32, 1)[0])
                    raw = zstandard.ZstdDecompressor().decompress(blob[4:])
                    docs_, at = _column(raw, 0, "<u2", n)
                    best, at = _column(raw, at, "<i8", n)
                    sums[0][docs_] += best
                    sums[1][docs_] += _column(raw, at, "<i8", n)[0]
                out[:, mid:high] = sums[:, places[mid:high]]
            mine = pa.array(places >= 0)
            facts = [batch.column(k).filter(mine) for k in (2, 3, 4, 5, 6)]
            yield pa.RecordBatch.from_arrays([*facts, facts[3], *[pa.array(x).filter(mine) for x in out]], schema.names)

    return dealt.mapInArrow(add, schema)


def cross_align(df: DataFrame, path_a: str, path_b: str, text: str = "text", shown: Callable[[Column], Column] = lambda groups: groups) -> DataFrame:
    """Adds ``n_a, n_b, n_groups, groups, n_links, n_best, count_sum`` to every row.

    A is a byte-level BPE file and reads a blank and the text, B a model of pieces, which adds the blank itself. ``groups``
    is what ``shown`` makes of ``a1,a2|b1;a3|b2,b3``: the text itself, or a digest where the groups are not needed.
    A link's count is how many links of the corpus hold its pair; it is best if no other pair of its B id has more."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text}`"))), F.lit(0)).alias("n")).first()["n"]
    radix_bits = min(B_BITS, max(LEAST_RADICES, -(-size // RADIX_BYTES)).bit_length())
    done = written(_aligned(df, path_a, path_b, text, radix_bits, shown), "crosstok-runs")
    runs, docs = done.where("radix >= 0"), done.where("radix < 0")
    totals = written(_totals(runs), "crosstok-counts")
    out = _added_up(docs, _streamed_back(runs, totals))
    kept = [f.name for f in docs.schema["row"].dataType.fields if f.name != "_"]
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *RESULTS)
