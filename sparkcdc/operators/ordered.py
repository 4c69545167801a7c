"""Order-dependent building blocks that never put one whole key into one task.

A long ordered sequence (a queue, a stream, a log) may hold a third of all rows. Everything
here splits such a sequence into buckets of the order column, works inside the buckets in
parallel, and passes a small summary row per bucket across them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcdc.session import stored


def bucket_of(value: Column, width: int) -> Column:
    """Start of the bucket of ``width`` units that holds ``value``."""
    return value - F.pmod(value, F.lit(width))


def asof_lookup(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    payload: Sequence[str],
    width: int,
    strict: bool = True,
    backward: bool = False,
) -> DataFrame:
    """For each left row, the nearest right row of the same ``by`` key in one direction.

    Forward takes the first right row with ``right_on > left_on`` (``>=`` when not strict),
    backward the last with ``right_on < left_on`` (``<=``). Ties on the right go to the least
    payload forward, the greatest backward. Left rows without a partner keep null payload.

    Values are cut into buckets of ``width`` units. A bucket that either side occupies becomes one row: the right
    side's distinct values in it, at most ``width`` of them, and the first value beyond it, which is carried from one
    occupied bucket to the next however far apart they are. The left side joins on its bucket, an equi join that
    needs no sort of the left and broadcasts whenever the bucket table is small. A left null has no partner.
    """
    by = list(by)
    sign = -1 if backward else 1
    item = F.struct(*[F.col(c) for c in payload])
    best = F.max(item) if backward else F.min(item)
    points = (
        right.where(F.col(right_on).isNotNull())
        .groupBy(*by, (F.col(right_on) * sign).alias("_v"))
        .agg(best.alias("_p"))
        .withColumn("_at", bucket_of(F.col("_v"), width))
    )
    entries = points.groupBy(*by, "_at").agg(F.sort_array(F.collect_list(F.struct("_v", "_p"))).alias("_entries"))
    value = F.col(left_on) * sign
    probe = left.withColumn("_at", bucket_of(value, width).cast(points.schema["_at"].dataType))
    asked = probe.where(F.col("_at").isNotNull()).select(*by, "_at").distinct()
    occupied = entries.join(asked, [*by, "_at"], "full")
    table = running(occupied, by, "_at", {"_beyond": ("last", F.get("_entries", F.lit(0)))}, width * 1024, reverse=True)
    joined = probe.join(table, [*by, "_at"], "left")
    found = F.try_element_at(
        F.filter("_entries", lambda e: (e["_v"] > value) if strict else (e["_v"] >= value)), F.lit(1)
    )
    hit = F.coalesce(found, F.col("_beyond"))
    return joined.withColumn("_hit", hit).select(
        *[F.col(c) for c in left.columns], *[F.col("_hit")["_p"][c].alias(c) for c in payload]
    )


def running(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    specs: dict[str, tuple[str, Column]],
    width: int,
    ties: Sequence[str] = (),
    inclusive: bool = False,
    reverse: bool = False,
) -> DataFrame:
    """Running aggregates along an integer order column, two-level.

    ``specs`` maps an output name to ``(kind, expression)`` with kind ``sum``, ``count``,
    ``max``, ``min`` or ``last`` (latest non-null value). Exclusive by default: the row itself
    is not counted. ``reverse`` runs from the end, so ``last`` then means the next value.
    """
    by = list(by)
    rows = df.withColumn("_b", bucket_of(F.col(order), width))
    inputs = {name: f"_in_{i}" for i, name in enumerate(specs)}
    for name, (_, expression) in specs.items():
        rows = rows.withColumn(inputs[name], expression)
    keys = [F.col(order), *[F.col(t) for t in ties]]
    at = F.struct(*keys)

    def total(kind: str, value: Column) -> Column:
        if kind == "last":
            pick = F.min_by if reverse else F.max_by
            return pick(value, F.when(value.isNotNull(), at))
        return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[kind](value)

    def over(kind: str, value: Column, window) -> Column:
        if kind == "last":
            return F.last(value, ignorenulls=True).over(window)
        return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[kind](value).over(window)

    parts = rows.groupBy(*by, "_b").agg(*[total(k, F.col(inputs[n])).alias(f"_t{inputs[n]}") for n, (k, _) in specs.items()])
    across = Window.partitionBy(*by).orderBy(F.col("_b").desc() if reverse else F.col("_b"))
    across = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(
        *by,
        "_b",
        *[
            over("sum" if k == "count" else k, F.col(f"_t{inputs[n]}"), across).alias(f"_c{inputs[n]}")
            for n, (k, _) in specs.items()
        ],
    )
    local = Window.partitionBy(*by, "_b").orderBy(*[k.desc() if reverse else k for k in keys])
    local = local.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    within = rows.select(
        *df.columns, "_b", *[over(k, F.col(inputs[n]), local).alias(f"_l{inputs[n]}") for n, (k, _) in specs.items()]
    )
    joined = within.join(carry, [*by, "_b"], "left")

    def merge(kind: str, name: str) -> Column:
        here, before = F.col(f"_l{inputs[name]}"), F.col(f"_c{inputs[name]}")
        if kind in ("sum", "count"):
            return F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
        if kind == "max":
            return F.greatest(here, before)
        if kind == "min":
            return F.least(here, before)
        return F.coalesce(here, before)

    return joined.select(*df.columns, *[merge(k, n).alias(n) for n, (k, _) in specs.items()])


def dense_positions(
    df: DataFrame, by: Sequence[str], order: str, name: str, width: int, ties: Sequence[str] = ()
) -> DataFrame:
    """1-based positions in order, without gaps, without a single-task sort."""
    return running(df, by, order, {name: ("count", F.lit(1))}, width, ties, inclusive=True)


def range_running(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: Column, name: str) -> DataFrame:
    """Inclusive running sum of ``weight`` in the order of any sortable columns, null first, per ``by`` (nulls are a
    group of their own).

    For orders that no fixed bucket width fits. Rows are dealt by ranges of (by, order), so a crowded stretch of
    it gets more ranges; only a sum per range passes from one to the next. The dealt rows are stored: ranges
    are drawn from a sample and must not change between the two reads. Rows with equal keys share a range, so
    ``order`` should end in something that tells rows apart.
    """
    by, order = list(by), list(order)
    ranged = df.repartitionByRange(*by, *order) if by or order else df
    parts = stored(ranged.select("*", weight.alias("_w"), F.spark_partition_id().alias("_part")))
    sums = parts.groupBy(*by, "_part").agg(F.sum("_w").alias("_t"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_of"), F.sum("_t").over(earlier).alias("_before"))
    local = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = parts.withColumn("_here", F.sum("_w").over(local))
    same = F.col("_part") == F.col("_of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return within.join(carry, same, "left").select(*df.columns, (F.col("_here") + F.coalesce("_before", F.lit(0))).alias(name))


def exact_median(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean of the two middle values per group, of a column of any number type; nulls do not count.

    Equal values are counted first, map-side, and the counts summed up over ranges of (by, value): neither a
    large group nor a frequent value is one task's.
    """
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    upto = range_running(counted, by, [value], F.col("_n"), "_upto")
    totals = upto.groupBy(*by).agg(F.max("_upto").alias("_total")).select(*[F.col(c).alias(f"_of_{c}") for c in by], "_total")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    both = upto.join(totals, same) if by else upto.withColumn("_total", upto.agg(F.max("_upto")).scalar())
    low, high = F.expr("(_total + 1) div 2"), F.expr("_total div 2 + 1")
    middle = [F.min(F.when(F.col("_upto") >= at, F.col(value))) for at in (low, high)]
    return both.groupBy(*by).agg((middle[0] * 0.5 + middle[1] * 0.5).alias(value))


def nearest_ranks(df: DataFrame, by: Sequence[str], value: str, ranks: dict[str, tuple], width: int) -> DataFrame:
    """Exact order statistics at index ``floor((n-1) * num / den)`` per group; ``ceil`` instead when a
    rank is given as ``(num, den, "ceil")``.

    ``value`` must be an integer column. Values are counted first, so the work after the
    partial aggregation grows with distinct values, not rows.
    """
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    placed = running(counted, by, value, {"_upto": ("sum", F.col("_n"))}, width, inclusive=True)
    totals = counted.groupBy(*by).agg(F.sum("_n").alias("_total"))
    both = placed.join(totals, by) if by else placed.withColumn("_total", counted.agg(F.sum("_n")).scalar())
    picks = []
    for name, (num, den, *rounding) in ranks.items():
        scaled = (F.col("_total") - 1) * num
        rest = F.pmod(scaled, F.lit(den))
        index = ((scaled - rest) / den).cast("bigint")
        if rounding == ["ceil"]:
            index = index + F.when(rest > 0, 1).otherwise(0)
        picks.append(F.min(F.when(F.col("_upto") > index, F.col(value))).alias(name))
    return both.groupBy(*by).agg(F.max("_total").alias("n"), *picks)
