"""Mixing sources to target weights.

A source's documents are repeated or thinned so that the words taken from it come near a target:
every document is taken floor(rate) times, plus once more with a probability of the fraction, decided
by a hash of the seed and its id. DataFrame functions only.

Nulls and ties: a null source is a source of its own and sorts last; a null text has no words; a row
without an id draws by its text, so a source without ids comes near its target too, and null texts share
a draw. Rows that repeat an id share its draw. Documents without words take
part with size 0. An empty table gives an empty result. Columns of the input never clash with the
working columns: the row travels as one struct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcdc.llm.common import WORD, written

#: 13 hex digits of a digest make an integer that a double holds exactly.
DRAW_DIGITS = 13


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the key alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.substring(F.md5(text), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / float(16**DRAW_DIGITS)


def source_sizes(docs: DataFrame, source: str, size: str) -> DataFrame:
    """One row per source: its name and its words. Summed map-side, so a hot source costs nothing."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("bigint").alias("source_size"))


def ranked(sources: DataFrame) -> DataFrame:
    """0-based position of each source by code point, null last.

    Sources are dealt by range, written, and numbered within each range; only a count per range is
    summed up in one place.
    """
    ordered = sources.repartitionByRange(F.col("source").asc_nulls_last())
    parts = written(ordered.withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    numbered = parts.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, "part").select("source", "source_size", (F.col("offset") + F.col("place")).alias("place"))


def water_fill(sources: DataFrame, cap: int) -> DataFrame:
    """Adds ``target``: the total of all sizes shared by ``weight``, no target above ``cap`` sizes.

    What a capped source leaves is shared again among the others by weight, until none is above.
    Each round is one aggregation over the sources; the driver sees three numbers a round. A round
    caps at least one more source, and the level only rises, so few rounds are needed.
    """
    sources = written(sources, "mix-weights")
    top = F.col("source_size") * cap

    def reaches(rest: int, weights: int) -> Column:
        left, right = F.lit(rest).cast("decimal(19,0)"), F.lit(weights).cast("decimal(19,0)")
        return left * F.col("weight").cast("decimal(19,0)") >= top.cast("decimal(19,0)") * right

    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    held, weights = 0, None
    while True:
        # A source is capped where its weight's share of what is left reaches its cap.
        capped = F.lit(False) if weights is None else reaches(total - held, weights)
        row = sources.agg(
            F.coalesce(F.sum(F.when(capped, top)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        if weights is not None and (row["held"], row["weights"]) == (held, weights):
            break
        held, weights = row["held"], row["weights"]
        if weights == 0:
            break
    share = F.lit(0.0) if not weights else (F.lit(total - held) * F.col("weight")).cast("double") / F.lit(float(weights))
    full = F.lit(True) if not weights else reaches(total - held, weights)
    return sources.select("source", "source_size", F.when(full, top.cast("double")).otherwise(share).alias("target"))


def rates(sizes: DataFrame, cap: int, weights: Sequence[int]) -> DataFrame:
    """Per source its size, target and repetition rate; weights repeat along the sources' order."""
    cycle = F.array(*[F.lit(int(w)).cast("bigint") for w in weights])
    placed = ranked(sizes).withColumn("weight", F.get(cycle, F.col("place") % len(weights)))
    filled = water_fill(placed, cap)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap))))
    return filled.withColumn("rate", F.coalesce(rate, F.lit(0.0)))


def copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
           weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: str = "mix") -> DataFrame:
    """One row per document: ``row`` (the input row), ``size``, ``source_size``, ``target``, ``rate``
    and ``copies``, how often the mix takes it.

    The join back is on the source; its right side has one row a source, is broadcast only if it is
    measured as small, and otherwise a hot source's partition is split by adaptive execution.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("#"), F.sha2(F.col(text), 256))).alias("key"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    known = rates(source_sizes(docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size")), "source", "size"), cap, weights)
    joined = rows.alias("d").join(known.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "left")
    whole = F.floor("s.rate")
    extra = F.when(draw(F.col("d.key"), seed) < F.col("s.rate") - whole, 1).otherwise(0)
    return joined.select(
        "d.row", "d.size", "s.source_size", "s.target", "s.rate", (whole + extra).cast("bigint").alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: the input's columns, each document as often as ``copies`` says."""
    taken = copies(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
