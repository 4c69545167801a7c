"""N-gram Jaccard self-join with parity sketches.

A document is the set of its word shingles. Sets are hashed into a bit sketch by XOR: every shingle
flips one bit. The sketches of two sets differ in no more bits than the sets differ in elements, and
sets that link differ in at most D elements, D known from their sizes. So for each band of sizes the
sketch is cut into more segments than D: two sets that link agree on some segment exactly, and an equi
join on (band, segment, bits) finds every link. What it finds is verified on the sets.

* Equal sets are one class; only classes are joined.
* There are some segments more than needed, so each set may leave out a few, the more the smaller it is
  within its band. It leaves out those with the fewest flips, which chance would match.
* A pair that agrees on a segment is dropped if whole sketches differ in more than D bits; only what is
  left is verified, and only for these are the texts read again.
* A segment shared by many sets is never expanded into all pairs. Each set is first verified against one of
  its segments' hubs, and what is linked becomes one component. Sets of one segment but different
  components are then compared by sketch, in blocks inside tasks, and only plausible pairs leave a task to
  be verified: first those that would join components, then all that are still apart. So no link between
  components is missed, and no cap is needed.

Nulls and ties: a null or empty text, or one of white space, has an empty set and links with nothing; a
row with a null id takes part like any other, and its component is the least id that is not null.
Rows that repeat an id or a text are rows of one class. An empty table gives an empty result. Only the
id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcdc.llm.common import written

#: Odd multipliers of a 64-bit mixing function.
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Words whose hash a task remembers before it starts afresh.
KNOWN_WORDS = 1 << 18
#: Ratio of neighbouring size bands.
BAND_RATIO = 1.3
#: Segments a band has beyond those it needs, for each side: one in so many.
SPARE = 12
#: Signatures are dealt in so many parts, one after the other.
PARTS = 2


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted 64-bit hashes of the distinct shingles of a text."""

    def __init__(self, width: int, limit: int = KNOWN_WORDS):
        self.width, self.limit = width, limit
        self.known: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        # On bytes, lower() and split() are A-Z and the six white space characters of ASCII.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for word in set(words).difference(known):
            known[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(self.width, len(words))
        n = len(words) - k + 1
        out = np.full(n, k, np.uint64)
        for j in range(k):
            out = mixed(out * _M1 + ids[j : n + j])
        return np.unique(out)


def set_key(hashes: np.ndarray) -> int:
    """Identity of a set, even, so that its last bit is free for a mark."""
    total = int(mixed(hashes ^ _M1).sum(dtype=np.uint64)) * int(_M3) + len(hashes)
    value = int(mixed(np.array([total & (2**64 - 1)], np.uint64))[0]) & ~1
    return value - 2**64 if value >= 2**63 else value


def sketch(hashes: np.ndarray) -> bytes:
    """Parities of the set in two to four bits an element, a power of two of them."""
    bits = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the length of the other."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


class Bands:
    """Size bands and how many segments each needs. Sets link if den * both >= num * either."""

    def __init__(self, num: int, den: int, ratio: float = BAND_RATIO):
        self.num, self.den, self.ratio = num, den, ratio
        self.lows = [1]

    def difference(self, a: int, b: int) -> int:
        """The most elements in which sets of these sizes that link can differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def band(self, n: int) -> int:
        while self.lows[-1] <= n:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * self.ratio)))
        return int(np.searchsorted(self.lows, n, side="right")) - 1

    def segments(self, band: int) -> int:
        """Number of segments of a band."""
        top = self.lows[band + 1] - 1
        need = self.difference(top, top) + 1
        return need + 2 * (need // SPARE)

    def spare(self, n: int, count: int) -> int:
        """How many of ``count`` segments a set of size n may leave out.

        With c = (den - num) / (den + num), sets of sizes a and b that link differ in c * (a + b) at most
        and agree on the other segments. If each leaves out (count - 1) / 2 - c * n at most, one is left.
        """
        return max(0, ((count - 1) * (self.den + self.num) - 2 * n * (self.den - self.num)) // (2 * (self.den + self.num)))

    def places(self, n: int) -> list[int]:
        """The set's own band and those that a larger partner can be in."""
        own, last = self.band(n), self.band(n * self.den // self.num)
        return list(range(own, last + 1))

    def signatures(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(signature, 1 where the band is the set's own) of each segment that is not left out."""
        out, own = [], []
        # A segment has 2**32 bits; which of them are set is held as the XOR of a hash of each flip, so that
        # two flips of one bit cancel as they do in the sketch.
        high, flip = hashes >> np.uint64(32), mixed((hashes & np.uint64(0xFFFFFFFF)) * _M1 + _M2)
        for place, band in enumerate(self.places(len(hashes))):
            count = self.segments(band)
            spare = self.spare(len(hashes), count)
            # Hashes are sorted, so their segments are too.
            segment = (high * np.uint64(count)) >> np.uint64(32)
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            bits = np.zeros(count, np.uint64)
            filled = segment[starts].astype(np.int64)
            bits[filled] = np.bitwise_xor.reduceat(flip, starts)
            names = np.arange(count, dtype=np.uint64)
            if spare:
                load = np.zeros(count, np.int64)
                load[filled] = np.diff(starts, append=len(hashes))
                kept = np.argsort(load, kind="stable")[spare:]
                names, bits = names[kept], bits[kept]
            out.append(mixed(mixed(bits + _M1) ^ mixed((names << np.uint64(16)) + np.uint64(band))))
            own.append(np.full(len(names), 1 if place == 0 else 0, np.int64))
        return np.concatenate(out).view(np.int64), np.concatenate(own)


def _mapped(docs: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """``fn(shingler, ids, texts)`` gives columns; slices keep what a task holds small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                yield pa.RecordBatch.from_arrays(fn(state, part.columns[:-1], part.column(part.num_columns - 1).to_pylist()), schema.names)

    return docs.mapInArrow(run, schema)


def shingle_classes(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """What names a row (``id`` and any column beside the text), ``n`` (set size), ``key`` (identity of the
    set) and ``sketch`` of every row, the last two null if the set is empty; ``sigs`` are the signatures of the
    set, the first ``own`` of them in its own band, null where the task has given them for that set before."""
    names = [c for c in docs.columns if c != "text"]

    def fn(state, columns, texts):
        shingler, bands, seen = state.setdefault("s", (Shingler(width), Bands(num, den), set()))
        if len(seen) > KNOWN_WORDS:
            seen.clear()
        sizes, keys, bits, sigs, own = [], [], [], [], []
        for text in texts:
            found = shingler.hashes(text)
            key = set_key(found) if len(found) else None
            sizes.append(len(found))
            keys.append(key)
            bits.append(None if key is None else sketch(found))
            if key is None or key in seen:
                sigs.append(None)
                own.append(None)
            else:
                seen.add(key)
                made, of_own = bands.signatures(found)
                sigs.append(made)
                own.append(int(of_own.sum()))
        made = [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(bits, pa.binary())]
        return [*columns, *made, pa.array(sigs, pa.list_(pa.int64())), pa.array(own, pa.int64())]

    made = [T.StructField("n", T.LongType()), T.StructField("key", T.LongType()), T.StructField("sketch", T.BinaryType()),
            T.StructField("sigs", T.ArrayType(T.LongType())), T.StructField("own", T.LongType())]
    return _mapped(docs.select(*names, "text"), fn, T.StructType([*[docs.schema[c] for c in names], *made]))


def signatures(classes: DataFrame) -> DataFrame:
    """``sig`` and ``mark`` (set key, last bit 1 where the band is its own) of every distinct set."""
    listed = classes.select("key", "own", F.posexplode("sigs").alias("pos", "sig"))
    return listed.select("sig", (F.col("key") + (F.col("pos") < F.col("own")).cast("bigint")).alias("mark"))


def shared_segments(sigs: DataFrame) -> DataFrame:
    """(sig, key, weight) of the segments that two classes or more share, one of them in its own band. Of segments
    that the same classes share one stands for all, ``weight`` is how many.

    Signatures are dealt by segment, sorted and read as a stream of which a task holds one batch; those
    that stand alone, nearly all, end here. The dealt signatures of one part are gone before the next is dealt.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last class of a segment waits for what follows; ``tied`` if the segment had another before it.
        last: tuple[np.ndarray, np.ndarray] | None = None
        tied = False
        for batch in batches:
            sig, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(sig):
                continue
            if last is not None:
                sig, mark = np.concatenate([last[0], sig]), np.concatenate([last[1], mark])
            # Of a class's rows the last one has its own band's mark, if any has.
            ends = np.flatnonzero(np.concatenate([(sig[1:] != sig[:-1]) | (mark[1:] >> 1 != mark[:-1] >> 1), [True]]))
            sig, mark = sig[ends], mark[ends]
            same = np.concatenate([[tied], sig[1:] == sig[:-1]])
            shared = same[:-1] | same[1:]
            yield pa.RecordBatch.from_arrays([pa.array(sig[:-1][shared]), pa.array(mark[:-1][shared])], ["sig", "mark"])
            last, tied = (sig[-1:], mark[-1:]), bool(same[-1])
        if tied:
            yield pa.RecordBatch.from_arrays([pa.array(last[0]), pa.array(last[1])], ["sig", "mark"])

    parts = []
    for part in range(PARTS):
        dealt = sigs.where(F.pmod("sig", F.lit(PARTS)) == part).repartition("sig").sortWithinPartitions("sig", "mark")
        parts.append(written(dealt.mapInArrow(run, sigs.schema), "join-shared"))
    own = F.col("mark").bitwiseAND(1)
    rows = reduce(DataFrame.union, parts).select("sig", (F.col("mark") - own).alias("key"), own.alias("own"))
    # Two hashes of all classes beside the count, the least and the greatest tell sets of classes apart.
    hashes = [F.bit_xor(F.xxhash64("key", F.lit(salt))).alias(f"all{salt}") for salt in (0, 1)]
    sized = rows.groupBy("sig").agg(F.max("own").alias("own"), F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"), *hashes)
    alike = sized.where("own = 1").groupBy("n", "lo", "hi", "all0", "all1").agg(F.min("sig").alias("sig"), F.count("*").alias("weight"))
    return rows.join(alike.select("sig", "weight"), "sig").select("sig", "key", "weight")


def sieve_marked(docs: DataFrame, chosen: DataFrame, names: list[str]) -> DataFrame:
    """The rows with ``_maybe``: true for every row that ``chosen`` names and, of the others, for about one in 32.

    Three of eight bits per chosen row say that a name may be among them. These bits, a byte a chosen row, are sent to all
    tasks, which the names themselves are too large for, and then only the texts of the rows found here need be dealt."""
    name, other = F.xxhash64(*names), F.xxhash64(*names, F.lit(1))
    # A bitmap of Spark's has 1 << 15 bits.
    bucket = F.pmod(name, F.lit(1 + 8 * chosen.count() // (1 << 15)))
    places = [F.shiftright(other, 15 * k).bitwiseAND(F.lit((1 << 15) - 1)) for k in range(3)]
    bits = chosen.select(bucket.alias("_bucket"), F.explode(F.array(*places)).alias("at")).groupBy("_bucket")
    # As a table its size is known before it is joined.
    bits = written(bits.agg(F.bitmap_construct_agg("at").alias("_bits")), "join-sieve")
    found = docs.join(F.broadcast(bits), bucket == F.col("_bucket"), "left")

    def hit(place: Column) -> Column:
        byte = F.conv(F.hex(F.substr("_bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
        return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1

    hits = reduce(and_, map(hit, places))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(hits, F.lit(False)).alias("_maybe"))


def sieved(docs: DataFrame, chosen: DataFrame, names: list[str]) -> DataFrame:
    """Every row that ``chosen`` names and few others."""
    return sieve_marked(docs, chosen, names).where("_maybe").drop("_maybe")


def shingle_sets(docs: DataFrame, classes: DataFrame, keys: DataFrame, width: int) -> DataFrame:
    """``key`` and ``hashes`` of the classes in ``keys``, each from one document of the class."""
    names = [c for c in docs.columns if c != "text"]
    # Where ids alone name rows, those that share one are told apart below; none is chosen only if there is no other.
    least = F.struct(F.min("id").alias("id")) if names == ["id"] else F.min(F.struct(F.col("id").isNull().alias("no_id"), *names))
    found = classes.join(keys, "key", "left_semi").groupBy("key").agg(least.alias("row"))
    chosen = found.select("key", *[f"row.{c}" for c in names])
    # As a table its size is known: the texts are not shuffled where their ids are few.
    chosen = written(chosen, "join-chosen")

    def fn(state, columns, found):
        shingler, seen = state.setdefault("s", (Shingler(width), set()))
        if len(seen) > KNOWN_WORDS:
            seen.clear()
        # The sieve lets some rows of other classes through, and more than one of a large class.
        sets = {set_key(s): s for s in map(shingler.hashes, found) if len(s)}
        new = [k for k in sets if k not in seen]
        seen.update(new)
        return [pa.array(new, pa.int64()), pa.array([sets[k].view(np.int64) for k in new], pa.list_(pa.int64()))]

    # The sets are dealt, not the texts as well.
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType()))])
    sets = _mapped(sieved(docs, chosen, names).select("text"), fn, schema)
    return sets.join(chosen.select("key"), "key", "left_semi").groupBy("key").agg(F.first("hashes").alias("hashes"))


def plausible(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sizes and sketches allow a link; other columns stay."""
    bands = Bands(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            most = (batch.column("na").to_numpy() + batch.column("nb").to_numpy()) * (bands.den - bands.num) // (bands.den + bands.num)
            kept = [sketch_distance(p.as_py(), q.as_py()) <= m for p, q, m in zip(x, y, most.tolist())]
            rest = batch.select([f for f in batch.schema.names if f not in ("x", "y", "na", "nb")])
            yield rest.filter(pa.array(kept, pa.bool_()))

    left = sketches.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    sized = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
    return sized.select(*pairs.columns, "x", "y", "na", "nb").mapInArrow(run, pairs.schema)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    left = sets.select(F.col("key").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("x", "y")))
    return both.where(F.col("both") * den >= (F.size("x") + F.size("y") - F.col("both")) * num).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``key`` and ``comp``, the least key it is connected with, of every key on an edge (a, b).

    Each step takes the least label among neighbours and then the label of that label, so a chain
    halves with every step; the table of labels is written each time.
    """
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = written(edges.select("a", "b").union(turned).distinct(), "join-edges")
    labels = written(both.groupBy(F.col("a").alias("key")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "join-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("key")).groupBy(F.col("a").alias("key")).agg(F.min("comp").alias("low"))
        lower = labels.join(near, "key").select("key", F.col("comp").alias("old"), F.least("comp", "low").alias("comp"))
        jump = labels.select(F.col("key").alias("comp"), F.col("comp").alias("next"))
        stepped = written(lower.join(jump, "comp").select("key", "old", F.least("comp", "next").alias("comp")), "join-labels")
        labels = stepped.select("key", "comp")
        if stepped.where("comp <> old").isEmpty():
            return labels


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("comp", F.col("key"))
    return rows.join(labels, "key", "left").withColumn("comp", F.coalesce("comp", "key"))


def _same(*pairs: tuple[Column, Column]) -> Column:
    """Nulls equal nulls."""
    return reduce(and_, [a.eqNullSafe(b) for a, b in pairs])


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


class Sets:
    """Shingle sets of the classes asked for so far, read from the documents when they are first needed."""

    def __init__(self, docs: DataFrame, classes: DataFrame, width: int):
        self.docs, self.classes, self.width = docs, classes, width
        self.parts: DataFrame | None = None

    def of(self, pairs: DataFrame) -> DataFrame:
        keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        if self.parts is not None:
            keys = keys.join(self.parts.select("key"), "key", "left_anti")
        new = written(shingle_sets(self.docs, self.classes, keys, self.width), "join-sets")
        self.parts = new if self.parts is None else self.parts.union(new)
        return self.parts


def links(segments: DataFrame, sketches: DataFrame, sets: Sets, num: int, den: int) -> DataFrame | None:
    """The components (key, comp) that links make, of the keys that have links; None without links."""
    found: DataFrame | None = None
    labels: DataFrame | None = None

    def verify(pairs: DataFrame) -> None:
        nonlocal found, labels
        if pairs.isEmpty():
            return
        more = written(verified(pairs, sets.of(pairs), num, den), "join-links")
        if not more.isEmpty():
            found = more if found is None else found.union(more)
            labels = components(found)

    hubs = segments.groupBy("sig").agg(F.min("key").alias("b"))
    stars = segments.withColumnRenamed("key", "a").join(hubs, "sig").where("a <> b").groupBy("a", "b").agg(F.sum("weight").alias("n"))
    likely = written(plausible(stars, sketches, num, den), "join-pairs")
    # First each class with the one hub it shares most with; that settles nearly all.
    best = likely.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b"))
    checked = written(best.select(*_ordered(F.col("a"), F.col("b"))).distinct(), "join-pairs")
    verify(checked)
    for forest in (True, False):
        # All pairs of different components in one segment are compared by sketch inside tasks. First the likeliest
        # ones that would join components are verified, then whatever is plausible and still apart.
        placed = _labelled(segments, labels)
        apart = placed.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        open_ = written(placed.join(apart.select("sig"), "sig", "left_semi").select("sig", "key", "comp"), "join-open")
        if open_.isEmpty():
            return labels
        fresh = plausible_in_segments(open_, sketches, num, den, forest).distinct().join(checked, ["a", "b"], "left_anti")
        fresh = written(fresh, "join-pairs")
        checked = checked.union(fresh)
        verify(fresh)
    return labels


#: Classes of a segment that are compared together.
BLOCK = 1024


class _Forest:
    """Which components plausible pairs have joined so far."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def joins(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[a] = b
        return a != b

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x


def _cell_pairs(cell: dict[str, list], most, forest: bool) -> list[tuple[int, int]]:
    """Plausible pairs of different components among the classes of a cell; across its two blocks if it has
    two. With ``forest``, the nearest pairs that join what they leave apart."""
    keys, comps, sizes, blocks = (np.array(cell[c], np.int64) for c in ("key", "comp", "n", "block"))
    words = [np.frombuffer(x, np.uint64) for x in cell["sketch"]]
    width = min(map(len, words))
    # Bits of a longer sketch fold onto those of a shorter one.
    rows = np.stack([np.bitwise_xor.reduce(w.reshape(-1, width), axis=0) for w in words])
    across = blocks[0] != blocks[-1]
    found = []
    for i in range(len(keys) - 1):
        others = slice(i + 1, None)
        far = np.bitwise_count(rows[others] ^ rows[i]).sum(axis=1, dtype=np.int64)
        near = (far <= most(sizes[others] + sizes[i])) & (comps[others] != comps[i])
        if across:
            near &= blocks[others] != blocks[i]
        at = np.flatnonzero(near)
        found += zip(far[at].tolist(), [i] * len(at), (at + i + 1).tolist())
    if forest:
        joined = _Forest()
        found = [f for f in sorted(found) if joined.joins(int(comps[f[1]]), int(comps[f[2]]))]
    return [tuple(sorted((int(keys[i]), int(keys[j])))) for _, i, j in found]


def plausible_in_segments(rows: DataFrame, sketches: DataFrame, num: int, den: int, forest: bool) -> DataFrame:
    """(a, b) of the classes of one segment but different components whose sketches allow a link.

    A segment's classes are dealt into blocks of about ``BLOCK``, and every two blocks meet in a cell, so a
    task holds two blocks whatever the segment holds. Only plausible pairs leave it.
    """
    bands = Bands(num, den)
    columns = ["sig", "i", "j", "key", "comp", "n", "block", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def most(total):
            return total * (bands.den - bands.num) // (bands.den + bands.num)

        cell: dict[str, list] = {c: [] for c in columns[3:]}
        at, out = None, []

        def close() -> None:
            if len(cell["key"]) > 1:
                out.extend(_cell_pairs(cell, most, forest))
            for values in cell.values():
                values.clear()

        def flushed() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])
            out.clear()
            return done

        for batch in batches:
            heads = np.stack([batch.column(c).to_numpy() for c in columns[:3]], axis=1)
            values = {c: batch.column(c).to_pylist() for c in columns[3:]}
            cuts = np.flatnonzero((heads[1:] != heads[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(heads)]):
                head = tuple(heads[start].tolist()) if end > start else at
                if head != at:
                    close()
                    at = head
                for c, part in values.items():
                    cell[c] += part[start:end]
            yield flushed()
        close()
        yield flushed()

    sized = rows.join(rows.groupBy("sig").agg(F.count("*").alias("rows")), "sig")
    blocks = F.ceil(F.col("rows") / BLOCK).cast("bigint")
    placed = sized.select("sig", "key", "comp", blocks.alias("blocks"), F.pmod(F.xxhash64("key"), blocks).alias("block"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    cells = met.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).join(sketches, "key").select(columns)
    dealt = cells.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j", "block", "key")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def labelled_classes(rows: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame | None]:
    """``shingle_classes`` of the rows, and the component of every class that has links (None without links)."""
    classes = written(shingle_classes(rows, width, num, den), "join-classes")
    segments = written(shared_segments(signatures(classes)), "join-segments")
    known = classes.join(segments.select("key").distinct(), "key", "left_semi")
    sketches = written(known.groupBy("key").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")), "join-sketches")
    return classes, links(segments, sketches, Sets(rows, classes, width), num, den)


def join_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 4, num: int = 85,
                    den: int = 100) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles`` and ``component_id``: the least id reachable by links between
    texts whose sets of ``width`` words have a Jaccard similarity of ``num / den`` or more."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    classes, labels = labelled_classes(rows, width, num, den)
    least = classes.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"))
    placed = written(_labelled(least, labels), "join-placed")
    lowest = placed.groupBy("comp").agg(F.min("id").alias("component_id"))
    of_key = placed.join(lowest, "comp").select("key", "component_id")
    return classes.join(of_key, "key", "left").select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 4, num: int = 85,
                den: int = 100) -> DataFrame:
    """The documents without near-duplicates: of each component the one with the least id, among equal ids
    the one whose text has the least digest; an id goes before none.

    A row is named by its id and its text, so rows that share an id, or have none, are decided each by its
    own text. Rows that repeat both count once. Texts with an empty set link with nothing and stay.
    """
    digest = F.unhex(F.sha2(F.col(f"`{text}`"), 256))
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), digest.alias("digest"), F.col(f"`{text}`").alias("text"))
    classes, labels = labelled_classes(rows, width, num, den)
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")
    least = classes.where("key IS NOT NULL").groupBy("key").agg(F.min(row).alias("row"))
    kept = _labelled(least, labels).groupBy("comp").agg(F.min("row").alias("row")).select("row.id", "row.digest", F.lit(True).alias("kept"))
    named = classes.groupBy("id", "digest").agg(F.count("*").alias("rows"), F.max("key").alias("key"))
    judged = named.alias("n").join(kept.alias("k"), _same(*[(F.col(f"n.{c}"), F.col(f"k.{c}")) for c in ("id", "digest")]), "left")
    loses = F.col("n.key").isNotNull() & F.col("k.kept").isNull()
    judged = written(judged.select(F.col("n.id").alias("_id"), F.col("n.digest").alias("_digest"), "rows", loses.alias("loses")), "join-judged")
    odd = judged.where("rows > 1 OR loses")
    # A row that the sieve leaves out stays without a join, which would deal its text. Of the others, most go: those
    # that stay have names that the sieve lets through and that do not lose, and these make a second sieve.
    names = ["_id", "_digest"]
    marked = sieve_marked(docs.withColumns({"_id": F.col(f"`{doc_id}`"), "_digest": digest}), odd, names)
    stay = written(sieved(judged.where("NOT loses"), odd, names), "join-stay")
    maybe = sieved(marked.where("_maybe").drop("_maybe"), stay, names)
    odd = odd.select(F.col("_id").alias("_odd_id"), F.col("_digest").alias("_odd_digest"), "loses")
    same = _same((F.col("_id"), F.col("_odd_id")), (F.col("_digest"), F.col("_odd_digest")))
    single = marked.where("NOT _maybe").drop("_maybe").union(maybe.join(odd.select("_odd_id", "_odd_digest"), same, "left_anti"))
    repeated = maybe.join(odd.where("NOT loses").select("_odd_id", "_odd_digest"), same, "left_semi").dropDuplicates([doc_id, text])
    return single.union(repeated).drop("_id", "_digest")
