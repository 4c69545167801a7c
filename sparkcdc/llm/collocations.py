"""Phrase collocations, counted with quotient filters.

1. Texts become blocks: a dictionary of words and one code per word occurrence, the break between pieces being a code
   as well. The dictionaries are dealt by word, added up, and words that occur often enough get numbers, which go back
   to the blocks that hold them.
2. A block's codes become these numbers. Every phrase of numbered words is packed into a few lanes, the lanes
   are permuted (a Feistel network: it can be undone, so nothing is lost), and the permuted phrases go into counting
   quotient filters, one per shard: the leading bits choose the shard, the next ones, the quotient, are kept as run
   lengths, and only the remainder of each phrase is stored, in full, beside a small counter.
3. The filters of a shard are sorted alike, so they are merged range by range; what is frequent enough is permuted
   back. This is done for pairs first. The frequent pairs of each block go back to it, and longer phrases are counted
   where all their pairs are frequent: a phrase is at most as frequent as its words and pairs, so no candidate is lost.
4. Candidates are few; scores and inclusion are joins on them.

Everything is per language; a null language is ``und``, a null text has no words. Repeated rows count as often as
they come. Ids and other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcdc.llm.common import numbered, numbering, written

#: What ends a piece, and the language of rows without one.
BREAKS, UNKNOWN = b".,;:!?\n\x0b\x0c\r", "und"
_BREAK = b"\xff"
_FOLD = bytes(0xFF if c in BREAKS else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes of text of a block, entries a shard is laid out for, entries merged at a time.
BLOCK_BYTES, SHARD_ENTRIES, RANGE = 8_000_000, 1 << 21, 1 << 18
_ROUNDS = 4


class Layout:
    """How phrases of up to ``words`` numbers below ``1 << bits`` are packed, permuted and cut."""

    def __init__(self, bits: int, words: int, shard_bits: int):
        lanes = max(2, -(-words // (64 // bits)))
        self.bits, self.words, self.shard_bits = bits, words, shard_bits
        self.per_lane = [words // lanes + (i < words % lanes) for i in range(lanes)]
        self.widths = [n * bits for n in self.per_lane]

    def pack(self, numbers: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Lanes of phrases given word by word; 0 stands for no word."""
        out, at = [], 0
        for n in self.per_lane:
            lane = np.zeros(len(numbers[0]), np.uint64)
            for k in range(at, at + n):
                lane = lane << np.uint64(self.bits) | (numbers[k].astype(np.uint64) if k < len(numbers) else np.uint64(0))
            out.append(lane)
            at += n
        return out

    def unpack(self, lanes: Sequence[np.ndarray]) -> list[np.ndarray]:
        out = []
        for n, lane in zip(self.per_lane, lanes):
            out += [(lane >> np.uint64(self.bits * (n - 1 - k)) & np.uint64((1 << self.bits) - 1)).astype(np.int64) for k in range(n)]
        return out

    def _steps(self) -> list[tuple[int, int, int]]:
        n = len(self.widths)
        return [(r * n + i, i, (i + 1) % n) for r in range(_ROUNDS) for i in range(n)]

    def _mixed(self, lane: np.ndarray, salt: int, width: int) -> np.ndarray:
        x = lane + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return (x ^ x >> np.uint64(31)) >> np.uint64(64 - width)

    def permute(self, lanes: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Each lane takes up a mixture of the next one, some rounds long."""
        out = list(lanes)
        for salt, i, j in self._steps():
            out[i] = out[i] ^ self._mixed(out[j], salt, self.widths[i])
        return out

    def undo(self, lanes: Sequence[np.ndarray]) -> list[np.ndarray]:
        out = list(lanes)
        for salt, i, j in reversed(self._steps()):
            out[i] = out[i] ^ self._mixed(out[j], salt, self.widths[i])
        return out

    def shard(self, lanes: Sequence[np.ndarray]) -> np.ndarray:
        return (lanes[0] >> np.uint64(self.widths[0] - self.shard_bits)).astype(np.int64)


def added_up(lanes: Sequence[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Permuted phrases in order, each once with its whole count."""
    order = np.lexsort(tuple(reversed(lanes)))
    lanes = [lane[order] for lane in lanes]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for lane in lanes:
        new[1:] |= lane[1:] != lane[:-1]
    heads = np.flatnonzero(new)
    return [lane[heads] for lane in lanes], np.add.reduceat(counts[order], heads) if len(heads) else counts


def to_filter(layout: Layout, lanes: Sequence[np.ndarray], counts: np.ndarray) -> bytes:
    """A shard's phrases, in order, as a counting quotient filter."""
    n = len(counts)
    free = layout.widths[0] - layout.shard_bits
    q = min(free, max(1, n.bit_length() - 1))
    quotient = (lanes[0] >> np.uint64(free - q)).astype(np.int64) & (1 << q) - 1
    # One bit per entry and one behind each quotient's run.
    runs = np.ones(n + (1 << q), np.uint8)
    runs[quotient + np.arange(n)] = 0
    widths = [free - q, *layout.widths[1:]]
    stored = [_low_bytes(lane, width) for lane, width in zip(lanes, widths)]
    small = np.minimum(counts, 255).astype(np.uint8)
    large = counts[counts >= 255].astype("<i8")
    head = np.array([n, q, len(large)], "<u8")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in (head, np.packbits(runs), *stored, small, large)))


def from_filter(layout: Layout, shard: int, raw: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """Phrases of a filter, in order, and their counts."""
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n, q, n_large = np.frombuffer(raw, "<u8", 3).tolist()
    at, bits = 24, n + (1 << q)
    runs = np.unpackbits(np.frombuffer(raw, np.uint8, -(-bits // 8), at), count=bits)
    at += -(-bits // 8)
    quotient = np.flatnonzero(runs == 0) - np.arange(n)
    free = layout.widths[0] - layout.shard_bits
    lanes = []
    for width in (free - q, *layout.widths[1:]):
        size = -(-width // 8)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :size] = np.frombuffer(raw, np.uint8, n * size, at).reshape(n, size)
        lanes.append(wide.view("<u8").reshape(n))
        at += n * size
    lanes[0] = lanes[0] | (quotient.astype(np.uint64) | np.uint64(shard << q)) << np.uint64(free - q)
    counts = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<i8", n_large, at + n)
    return lanes, counts


def _low_bytes(lane: np.ndarray, width: int) -> np.ndarray:
    kept = lane & np.uint64((1 << width) - 1)
    return np.ascontiguousarray(kept.astype("<u8").view(np.uint8).reshape(len(lane), 8)[:, : -(-width // 8)])


def merge_filters(layout: Layout, shard: int, filters: Sequence[bytes]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Sorted filters of one shard as one, a range of quotients at a time."""
    held = [from_filter(layout, shard, raw) for raw in filters]
    total = sum(len(counts) for _, counts in held)
    free = layout.widths[0] - layout.shard_bits
    bits = min(free, max(0, (total // RANGE).bit_length()))
    low = [0] * len(held)
    for step in range(1 << bits):
        bound = np.uint64((shard << bits | step) << (free - bits) | (1 << (free - bits)) - 1)
        high = [int(np.searchsorted(lanes[0], bound, "right")) for lanes, _ in held]
        lanes = [np.concatenate([lanes[i][a:b] for (lanes, _), a, b in zip(held, low, high)]) for i in range(len(layout.widths))]
        counts = np.concatenate([counts[a:b] for (_, counts), a, b in zip(held, low, high)])
        low = high
        if len(counts):
            yield added_up(lanes, counts)


def _blocks(docs: DataFrame) -> DataFrame:
    """``(block, lang, n, words, counts, codes)``: n word occurrences; word 0 is the break between pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, held = TaskContext.get().partitionId() << 32, 0, {}

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang, (words, codes) in held.items():
                flat = np.concatenate(codes).astype("<i4")
                counts = np.bincount(flat, minlength=len(words))
                names = ["", *[w.decode() for w in list(words)[1:]]]
                packed = zstandard.ZstdCompressor(level=1).compress(flat.tobytes())
                row = [[number], [lang], [int(counts[1:].sum())], [names], [counts.tolist()], [packed]]
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
                columns = [pa.array(x, k) for x, k in zip(row, kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "lang", "n", "words", "counts", "codes"])
                number += 1

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            for k, lang in enumerate(langs):
                raw = texts[k].as_buffer()
                if raw is None:
                    continue
                if lang not in held:
                    held[lang] = numbering(), []
                    held[lang][0][_BREAK]
                words, codes = held[lang]
                cut = bytes(raw).translate(_FOLD).replace(_BREAK, b" \xff ").split()
                cut.append(_BREAK)
                codes.append(numbered(words, cut).astype(np.int32))
                size += len(raw)
                if size >= BLOCK_BYTES:
                    yield from flushed()
                    size, held = 0, {}
        yield from flushed()

    return docs.mapInArrow(run, "block bigint, lang string, n bigint, words array<string>, counts array<bigint>, codes binary")


def _per_shard(dealt: DataFrame, work, schema: str) -> DataFrame:
    """``work(lang, shard, [(block, bytes)])`` for every shard of a language; it yields rows of ``schema``."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["lang"], row["shard"]) != here:
                    if held:
                        yield from work(*here, held)
                    here, held = (row["lang"], row["shard"]), []
                held.append((row["block"], row["part"]))
        if held:
            yield from work(*here, held)

    laid = dealt.select("lang", "shard", "block", "part").repartition("lang", "shard").sortWithinPartitions("lang", "shard", "block")
    return laid.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays(columns, names) for columns in run(batches)), schema)


def _dealt_words(blocks: DataFrame, shards: int) -> DataFrame:
    """Every block's words with their counts and places, in parts by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, lang, words, counts = (batch.column(c)[k].as_py() for c in range(4))
                raw = [w.encode() for w in words]
                shard = np.fromiter((zlib.crc32(w) % shards for w in raw), np.int64, len(raw))
                shard[0] = -1
                counts = np.array(counts, "<i8")
                own, parts = [], []
                for s in np.unique(shard[1:]).tolist():
                    at = np.flatnonzero(shard == s)
                    own.append(s)
                    text = b" ".join([raw[i] for i in at.tolist()])
                    head = np.array([len(at)], "<i8").tobytes()
                    parts.append(zstandard.ZstdCompressor(level=1).compress(head + at.astype("<i8").tobytes() + counts[at].tobytes() + text))
                columns = [pa.array([lang] * len(own), pa.string()), pa.array(own, pa.int32()), pa.array([block] * len(own), pa.int64()), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "shard", "block", "part"])

    return blocks.select("block", "lang", "words", "counts").mapInArrow(run, "lang string, shard int, block bigint, part binary")


def _numbered_words(parts: DataFrame, shards: int, min_count: int) -> DataFrame:
    """Two sorts of rows: frequent words with count and number, and per block the places of such words."""

    def read(part: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        raw = zstandard.ZstdDecompressor().decompress(part)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        return np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, "<i8", n, 8 + 8 * n), raw[8 + 16 * n :].split(b" ")

    def work(lang, shard, held) -> Iterator[list[pa.Array]]:
        words, total = numbering(), np.zeros(0, np.int64)
        for _, part in held:
            _, counts, raw = read(part)
            at = numbered(words, raw)
            total = np.concatenate([total, np.zeros(len(words) - len(total), np.int64)])
            total[at] += counts
        names = list(words)
        often = sorted(np.flatnonzero(total >= min_count).tolist(), key=names.__getitem__)
        number = np.zeros(len(names), np.int64)
        number[often] = np.arange(len(often)) * shards + shard + 1
        n = len(often)
        if n:
            yield [pa.array([lang] * n, pa.string()), pa.array([names[i].decode() for i in often], pa.string()), pa.array(total[often]),
                   pa.array(number[often]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
        for block, part in held:
            at, _, raw = read(part)
            ids = number[numbered(words, raw)]
            there = ids > 0
            if there.any():
                found = np.stack([at[there], ids[there]]).astype("<i8").tobytes()
                yield [pa.array([lang], pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                       pa.array([block], pa.int64()), pa.array([zstandard.ZstdCompressor(level=1).compress(found)], pa.binary())]

    return _per_shard(parts, work, "lang string, word string, f bigint, id bigint, block bigint, known binary")


def _unpacked(parts: Sequence[bytes], rows: int) -> np.ndarray:
    reader = zstandard.ZstdDecompressor()
    return np.concatenate([np.zeros((rows, 0), "<i8"), *[np.frombuffer(reader.decompress(p), "<i8").reshape(rows, -1) for p in parts]], axis=1)


def _filters(coded: DataFrame, layout: Layout, sizes: Sequence[int]) -> DataFrame:
    """Counts of the phrases of these sizes, as one filter per block and shard. Phrases longer than two words
    only where all their pairs are in the block's ``pairs``."""

    def phrases(ids: np.ndarray, pairs: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
        lanes, counts = [[np.zeros(0, np.uint64)] for _ in layout.widths], [np.zeros(0, np.int64)]
        joined = (ids[:-1] > 0) & (ids[1:] > 0)
        if pairs is not None:
            joined &= np.isin(ids[:-1] << 32 | ids[1:], pairs)
        ok = joined
        for size in range(2, max(sizes) + 1):
            if size > 2:
                ok = ok[:-1] & joined[size - 2 :]
            if size not in sizes:
                continue
            at = np.flatnonzero(ok)
            # One size at a time: sizes never meet.
            packed, n = added_up(layout.permute(layout.pack([ids[at + k] for k in range(size)])), np.ones(len(at), np.int64))
            for lane, part in zip(lanes, packed):
                lane.append(part)
            counts.append(n)
        return added_up([np.concatenate(parts) for parts in lanes], np.concatenate(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, lang, raw, known, pairs = (batch.column(c)[k].as_py() for c in range(5))
                codes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "<i4")
                number_of = np.zeros(int(codes.max()) + 1, np.int64)
                at, number = _unpacked(known, 2)
                number_of[at] = number
                lanes, counts = phrases(number_of[codes], None if pairs is None else _unpacked(pairs, 1)[0])
                shard = layout.shard(lanes)
                cuts = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
                parts = [to_filter(layout, [lane[low:high] for lane in lanes], counts[low:high]) for low, high in zip(cuts, [*cuts[1:], len(shard)])]
                n = len(parts)
                columns = [pa.array([lang] * n, pa.string()), pa.array(shard[cuts], pa.int32()), pa.array([block] * n, pa.int64()), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "shard", "block", "part"])

    return coded.mapInArrow(run, "lang string, shard int, block bigint, part binary")


def _frequent(filters: DataFrame, layout: Layout, min_count: int, back: bool) -> DataFrame:
    """Two sorts of rows: phrases that reach ``min_count`` over all filters of their shard, as lists of word numbers,
    and, if ``back``, which of these pairs each block's filter holds."""

    def joined(lanes) -> np.ndarray:
        first, second = layout.unpack(layout.undo(lanes))[:2]
        return first << 32 | second

    def work(lang, shard, held) -> Iterator[list[pa.Array]]:
        pairs = [np.zeros(0, np.int64)]
        for lanes, counts in merge_filters(layout, shard, [part for _, part in held]):
            often = counts >= min_count
            if often.any():
                lanes = [lane[often] for lane in lanes]
                if back:
                    pairs.append(joined(lanes))
                ids = [[n for n in row if n] for row in np.stack(layout.unpack(layout.undo(lanes)), axis=1).tolist()]
                n = len(ids)
                yield [pa.array([lang] * n, pa.string()), pa.array(ids, pa.list_(pa.int64())), pa.array(counts[often]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())]
        often = np.concatenate(pairs)
        for block, part in held if len(often) else ():
            own = joined(from_filter(layout, shard, part)[0])
            own = own[np.isin(own, often)]
            if len(own):
                found = zstandard.ZstdCompressor(level=1).compress(np.sort(own).astype("<i8").tobytes())
                yield [pa.array([lang], pa.string()), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.int64()), pa.array([block], pa.int64()), pa.array([found], pa.binary())]

    return _per_shard(filters, work, "lang string, ids array<bigint>, f bigint, block bigint, pairs binary")


def _per_block(rows: DataFrame, name: str) -> DataFrame:
    """What came back to each block, one part per shard."""
    return rows.where(F.col(name).isNotNull()).groupBy("block").agg(F.collect_list(name).alias(name))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 100, max_words: int = 5, share: int = 100) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)``: phrases of 2 to ``max_words`` words with ``a >= min_count`` occurrences.

    ``n`` counts the language's words. Cut after its first words a phrase falls into parts with ``l`` and ``r``
    occurrences; ``score`` is floor(1000 a n / (l r)) of the cut where it is least, the first of equal ones. A phrase
    that lies within a longer candidate with at least ``share`` percent of its occurrences is left out."""
    given = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").alias("text"))
    blocks = written(_blocks(given), "phrase-blocks")
    sizes = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    shards = 16 + (blocks.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n")).first()["n"] * 4) // SHARD_ENTRIES
    numbers = written(_numbered_words(_dealt_words(blocks, shards), shards, min_count), "phrase-words")
    words = numbers.where(F.col("word").isNotNull()).select("lang", "word", "f", "id")
    facts = words.agg(F.coalesce(F.max("id"), F.lit(1)).alias("top"), F.coalesce(F.sum("f"), F.lit(0)).alias("held")).first()
    bits = max(2, int(facts["top"]).bit_length())
    if bits > 31:
        raise ValueError("more frequent words than a pair of numbers holds")
    layout = Layout(bits, max_words, min(bits, (16 + facts["held"] // SHARD_ENTRIES).bit_length()))

    coded = blocks.select("block", "lang", "codes").join(_per_block(numbers, "known"), "block")
    pairs = _filters(coded.withColumn("pairs", F.lit(None).cast("array<binary>")), layout, [2])
    pairs = written(_frequent(pairs, layout, min_count, back=max_words > 2), "phrase-pairs")
    found = pairs.where(F.col("f").isNotNull()).select("lang", "ids", "f")
    if max_words > 2:
        longer = _filters(coded.join(_per_block(pairs, "pairs"), "block"), layout, range(3, max_words + 1))
        longer = written(_frequent(longer, layout, min_count, back=False), "phrase-counts")
        found = found.unionByName(longer.where(F.col("f").isNotNull()).select("lang", "ids", "f"))

    both = found.unionByName(words.select("lang", F.array("id").alias("ids"), "f"))
    size = F.size("ids")
    cuts = found.select("lang", "ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("_l", F.slice("ids", F.lit(1), F.col("k"))).withColumn("_r", F.slice("ids", F.col("k") + 1, size - F.col("k")))
    for part, name in (("_l", "l"), ("_r", "r")):
        cuts = cuts.join(both.select("lang", F.col("ids").alias(part), F.col("f").alias(name)), ["lang", part])
    cuts = cuts.join(sizes, "lang")
    # Exact: a product of three counts passes 64 bits.
    score = F.expr("(cast(a AS decimal(38,0)) * n * 1000) div (cast(l AS decimal(38,0)) * r)")
    least = cuts.groupBy("lang", "ids", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_m"))

    starts = F.sequence(F.lit(0), size * size - 1)
    inner = found.where(size > 2).select("lang", "ids", "f", F.explode(starts).alias("_s"))
    first, length = F.expr("cast(_s div size(ids) as int)"), F.expr("cast(_s % size(ids) as int)")
    inner = inner.where((length >= 2) & (first + length <= size)).select("lang", F.slice("ids", first + 1, length).alias("ids"), "f")
    covered = inner.groupBy("lang", "ids").agg(F.max("f").alias("_top"))
    kept = least.join(covered, ["lang", "ids"], "left").where(F.coalesce(100 * F.col("_top") < share * F.col("a"), F.lit(True)))

    spelt = kept.select("lang", "ids", F.posexplode("ids").alias("_at", "id")).join(words.select("lang", "id", "word"), ["lang", "id"])
    spelt = spelt.groupBy("lang", "ids").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    return kept.join(spelt, ["lang", "ids"]).select("lang", "phrase", "a", F.col("_m.l").alias("l"), F.col("_m.r").alias("r"), "n", F.col("_m.score").alias("score"))


def best(found: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top`` phrases by score, occurrences and spelling, with their ``rank``."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # A language's phrases are ranked in parts first, so that no task ranks all of them.
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    few = found.withColumn("_r", F.row_number().over(parts)).where(F.col("_r") <= top).drop("_r")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= top)
