"""Document fingerprints by one-permutation MinHash. DataFrame functions only.

Every word shingle is hashed once. The hash's high bits choose one of ``bins`` bins, a bin keeps the least
hash that fell into it, and an empty bin takes the value of a bin that has one: optimal densification, in
which every empty bin probes bins in a hashed order of its own until it meets a filled one (after a few
probes, the filled one with the least hash of the two bins), so that sets with the same filled bins draw alike. Of each value, hashed with its bin so that a donor does not repeat itself, the low ``bits`` bits are stored.
Values that agree by chance, one in 2**bits, are taken out of the similarity.

Nulls and ties: a null text is empty. A text without words has the fingerprint ``""``, like 1 to another such
text and 0 to any other. A text of fewer words than a shingle is one shingle. Equal texts have equal
fingerprints. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcdc.llm.common import sha256
from sparkcdc.operators.ordered import running

WIDTH = 5
BINS = 256
BITS = 8
#: Documents of neighbouring ids that are dealt together.
NEIGHBOURS = 256
#: Probes of an empty bin before all filled bins are looked at.
PROBES = 6


def _once(value: Column, use) -> Column:
    """``use(value)`` for an array-valued ``use``, with the value computed once: it is named by a lambda."""
    return F.flatten(F.transform(F.array(value), use))


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """One 64-bit hash per word shingle, repeats included; an empty array without words."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")

    def of(found: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(found) - (width - 1), F.lit(1)))
        hashed = F.transform(places, lambda i: F.xxhash64(F.slice(found, i, width)))
        return F.when(F.size(found) > 0, hashed).otherwise(F.array().cast("array<bigint>"))

    return _once(words, of)


def minima(hashes: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """``bins`` stored values in bin order, donors filled in; empty for an empty set."""
    shift = 64 - bins.bit_length() + 1
    # Sorted by value, a bin's hashes stand together, the least first; bins run from the negative half up.
    low, high = -(bins // 2), bins // 2 - 1
    mask = (1 << bits) - 1

    def bin_of(h: Column) -> Column:
        return F.shiftright(h, shift)

    def firsts(sorted_: Column) -> Column:
        return F.filter(sorted_, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(sorted_, i - 1))))

    def densified(filled: Column) -> Column:
        by_bin = F.map_from_arrays(F.transform(filled, bin_of), filled)

        def value(j: Column, known: Column) -> Column:
            probes = [F.try_element_at(known, F.pmod(F.xxhash64(j, F.lit(t)), F.lit(bins)) + low) for t in range(PROBES)]
            drawn = F.array_min(F.transform(filled, lambda h: F.struct(F.xxhash64(j, bin_of(h)).alias("draw"), h.alias("h"))))
            return F.coalesce(F.try_element_at(known, j), *probes, drawn["h"])

        def stored(known: Column) -> Column:
            places = F.sequence(F.lit(low), F.lit(high)).cast("array<bigint>")
            return F.transform(places, lambda j: F.xxhash64(value(j, known), j).bitwiseAND(F.lit(mask)).cast("smallint"))

        return F.when(F.size(filled) > 0, _once(by_bin, stored)).otherwise(F.array().cast("array<smallint>"))

    return _once(_once(F.sort_array(hashes), firsts), densified)


def fingerprint(text: Column, width: int = WIDTH, bins: int = BINS, bits: int = BITS) -> Column:
    """Stored values of a text, as an array of ``bins`` small integers or none."""
    return minima(shingle_hashes(text, width), bins, bits)


def packed(values: Column, bits: int = BITS) -> Column:
    """The values side by side, ``bits`` each, in lowercase hex. ``bits`` is a multiple of 4."""
    digits = bits // 4
    return F.lower(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), digits, "0")), ""))


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity of the sets behind two arrays of stored values, 0 to 1."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    chance = 1 / 2**bits
    raw = (equal / F.lit(bins) - chance) / (1 - chance)
    both = F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(both)


def with_next(rows: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """Adds ``next``: the ``carried`` columns of the row that follows by ``key`` (then by those columns),
    of the first row for the last one.

    Rows are dealt by buckets of the key. A bucket's last row finds its successor among the first rows of
    the buckets, one row each, through the bucket that follows.
    """
    order = [F.col(key), *[F.col(c) for c in carried]]
    bucketed = rows.withColumn("_bucket", F.coalesce(F.floor(F.col(key) / NEIGHBOURS).cast("bigint"), F.lit(-(2**62))))
    inside = Window.partitionBy("_bucket").orderBy(*order)
    # Columns one by one: a struct of them would travel beside them.
    ahead = bucketed.select(
        "*", *[F.lead(c).over(inside).alias(f"_next_{c}") for c in carried],
        F.lead(F.lit(True)).over(inside).isNull().alias("_last"), F.lag(F.lit(True)).over(inside).isNull().alias("_first"),
    )
    following_row = F.struct(*[F.col(f"_next_{c}").alias(c) for c in carried])
    placed = ahead.select(*rows.columns, "_bucket", "_first", F.when(~F.col("_last"), following_row).alias("next"))
    # The same exchange as above: what is carried is not computed again.
    heads = placed.where("_first").select("_bucket", F.struct(*carried).alias("_head"))
    buckets = bucketed.select("_bucket").distinct()
    lowest = buckets.agg(F.min("_bucket").alias("_lowest")).scalar()
    after = running(buckets, [], "_bucket", {"_after": ("last", F.col("_bucket"))}, NEIGHBOURS, reverse=True)
    following = after.select("_bucket", F.coalesce("_after", lowest).alias("_after"))
    successors = following.join(heads.select(F.col("_bucket").alias("_after"), "_head"), "_after").select("_bucket", "_head")
    last = placed.where("next IS NULL").drop("next").join(successors, "_bucket").withColumnRenamed("_head", "next")
    kept = [*rows.columns, "next"]
    return placed.where("next IS NOT NULL").select(kept).unionByName(last.select(kept))


def compared(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, whose last half is the next one's beginning."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = rows.withColumn("values", fingerprint(F.col("text")))
    pairs = with_next(own, "id", ["text", "values"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - half), F.col("next.text").substr(F.lit(1), half))
    seen = pairs.select("id", n.cast("bigint").alias("n_chars"), "values", F.col("next.values").alias("next_values"), edited.alias("edited"))
    marked = seen.select("id", "n_chars", "values", "next_values", sha256(F.col("edited")).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_values"))
    return marked.select(
        F.col("id").alias(doc_id), "n_chars", "edited_sha256",
        packed(F.col("values")).alias("fingerprint"), packed(F.col("edited_values")).alias("edited_fingerprint"),
        likeness(F.col("values"), F.col("edited_values")).alias("near_edited"), likeness(F.col("values"), F.col("next_values")).alias("near_next"),
    )
