"""Progress boundaries and the consumer that trusts them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcdc.operators.ordered import asof_lookup, running
from sparkcdc.operators.segments import Measure, greedy_cuts

MAX_VALUE_BYTES = 1 << 20


def due_batches(batches: DataFrame, every_us: int, by: Sequence[str] = ("stream",)) -> DataFrame:
    """Batches after which a boundary is due: the first, then each that ends at least ``every_us`` after
    the last due one. ``batches(by, tick_id, end_us)``; zero turns boundaries off."""
    if every_us == 0:
        return batches.limit(0)
    cut = greedy_cuts(batches, by, "tick_id", [Measure("end_us", every_us - 1, running=False)], "_due")
    return cut.where(F.col("_due_start")).drop("_due", "_due_start")


def boundaries(batches: DataFrame, routes: DataFrame, every_us: int, by: Sequence[str] = ("stream",)) -> DataFrame:
    """One boundary per due batch on every route of its stream, idle routes included.

    ``routes(by, topic)`` holds at most a few topics per stream, so this equi join only multiplies
    batches, never events. ``batches`` of external tickers do not qualify and are dropped.
    """
    if "external" in batches.columns:
        batches = batches.where(~F.col("external")).drop("external")
    return due_batches(batches, every_us, by).join(routes, list(by))


def merge_log(data: DataFrame, marks: DataFrame, by: Sequence[str], spacing: int = 1, width: int = 1 << 16) -> DataFrame:
    """Data and boundaries of each topic in one order: the rows of a batch, its boundary, the next batch.

    ``data(by, tick_id, ev_id, ...)``, ``marks(by, tick_id, ...)``. Adds ``kind`` and ``offset`` (``spacing``
    times the position; holes are legal). Positions come from per-batch counts, not one sort.
    """
    marked = marks.withColumn("kind", F.lit("boundary")).withColumn("ev_id", F.lit(None).cast("bigint"))
    both = data.withColumn("kind", F.lit("data")).unionByName(marked, allowMissingColumns=True)
    both = both.withColumn("_last", (F.col("kind") == "boundary").cast("int"))
    # Inside a batch, ids are cut into ranges so that one huge batch is still many tasks.
    per_range = both.withColumn("_range", F.when(F.col("kind") == "data", F.expr(f"ev_id div {width}")).otherwise(F.lit((1 << 62))))
    counted = per_range.groupBy(*by, "tick_id", "_range").agg(F.count("*").alias("_n"))
    inside = running(counted, [*by, "tick_id"], "_range", {"_in_batch": ("sum", F.col("_n"))}, 1 << 40)
    per_batch = counted.groupBy(*by, "tick_id").agg(F.sum("_n").alias("_n"))
    before = running(per_batch, by, "tick_id", {"_in_topic": ("sum", F.col("_n"))}, 1 << 16)
    starts = inside.join(before.drop("_n"), [*by, "tick_id"]).select(
        *by, "tick_id", "_range", (F.col("_in_batch") + F.col("_in_topic")).alias("_start")
    )
    within = Window.partitionBy(*by, "tick_id", "_range").orderBy("ev_id")
    placed = per_range.withColumn("_pos", F.row_number().over(within)).join(starts, [*by, "tick_id", "_range"])
    offset = (F.col("_start") + F.col("_pos")) * spacing
    return placed.withColumn("offset", offset.cast("bigint")).drop("_last", "_range", "_pos", "_start")


def check_log(log: DataFrame, scope: DataFrame, epoch, topic: str, skew_us: int = 0, width: int = 1 << 16) -> tuple[DataFrame, DataFrame]:
    """Accepted records and, per consumer, the first refusal, which is final.

    ``log(consumer, seq, topic, partition, offset, key, value_bytes, kind, version, boundary_us, now_us,
    schema_name, table_name, reason)`` in arrival order ``seq``. Offsets must rise (holes are legal), the key is
    the epoch, boundaries are version 1, present, never falling and not ahead of the clock by more
    than ``skew_us``; data must be valid and from a table in ``scope(schema_name, table_name)``.
    """
    known = log.join(scope.select("schema_name", "table_name", F.lit(True).alias("_in_scope")), ["schema_name", "table_name"], "left")
    mark = F.when(F.col("kind") == "boundary", F.col("boundary_us"))
    seen = running(known, ["consumer"], "seq", {"_offset": ("max", F.col("offset")), "_mark": ("max", mark)}, width)
    problem = (
        F.when(~F.col("topic").eqNullSafe(F.lit(topic)), F.lit("other topic"))
        .when(F.col("partition") != 0, F.lit("other partition"))
        .when(F.col("offset") <= F.col("_offset"), F.lit("offset does not rise"))
        .when(~F.col("key").eqNullSafe(epoch), F.lit("other epoch"))
        .when(F.col("value_bytes") > MAX_VALUE_BYTES, F.lit("record too large"))
        .when(
            F.col("kind") == "boundary",
            F.when(~F.col("version").eqNullSafe(F.lit(1)), F.lit("unknown version"))
            .when(F.col("boundary_us").isNull(), F.lit("missing boundary"))
            .when(F.col("boundary_us") < F.col("_mark"), F.lit("boundary falls"))
            .when(F.col("boundary_us") > F.col("now_us") + skew_us, F.lit("boundary in the future")),
        )
        .when(F.col("reason").isNotNull(), F.lit("invalid change"))
        .when(F.col("_in_scope").isNull(), F.lit("unknown table"))
    )
    # The verdict of a row after the first refusal does not matter, so running maxima over all
    # earlier rows decide the first refusal exactly.
    judged = seen.withColumn("problem", problem).drop("_offset", "_mark", "_in_scope")
    first = judged.where(F.col("problem").isNotNull()).groupBy("consumer").agg(F.min(F.struct("seq", "problem")).alias("_f"))
    failures = first.select("consumer", F.col("_f")["seq"].alias("failed_seq"), F.col("_f")["problem"].alias("problem"))
    accepted = judged.join(failures.select("consumer", "failed_seq"), "consumer", "left").where(
        F.col("failed_seq").isNull() | (F.col("seq") < F.col("failed_seq"))
    )
    return accepted.drop("problem", "failed_seq"), failures


def leases(accepted: DataFrame, started_us, max_lag_us: int, skew_us: int, width: int = 1 << 16) -> DataFrame:
    """Spans in which the cache may be used: ``(consumer, seq, from_us, until_us)`` per boundary.

    A boundary later than the start plus skew lends until itself plus max lag minus skew. Seeing the
    same boundary again never lends longer, and the next boundary replaces the span. ``started_us``
    is a column or literal.
    """
    started = started_us if isinstance(started_us, Column) else F.lit(started_us)
    marks = accepted.where(F.col("kind") == "boundary").withColumn("_started", started)
    # Expiry depends on the boundary alone, so a repeat inherits exactly the same instant.
    expiry = F.when(F.col("boundary_us") > F.col("_started") + skew_us, F.col("boundary_us") + (max_lag_us - skew_us))
    following = running(marks, ["consumer"], "seq", {"_next_us": ("last", F.col("now_us"))}, width, reverse=True)
    return following.where(expiry.isNotNull()).select(
        "consumer", "seq", F.col("now_us").alias("from_us"), expiry.alias("expiry_us"), F.least(expiry, F.col("_next_us")).alias("until_us")
    )


def ready_at(probes: DataFrame, spans: DataFrame, failures: DataFrame, width_us: int) -> DataFrame:
    """Adds ``ready``: the probe falls inside the newest span and before the consumer failed.

    ``probes(consumer, at_us)``, ``failures(consumer, failed_us)``.
    """
    right = spans.select("consumer", "from_us", "until_us")
    found = asof_lookup(probes, right, ["consumer"], "at_us", "from_us", ["until_us"], width_us, strict=False, backward=True)
    joined = found.join(failures.select("consumer", "failed_us"), "consumer", "left")
    alive = F.col("failed_us").isNull() | (F.col("at_us") < F.col("failed_us"))
    return joined.withColumn("ready", F.coalesce(F.col("at_us") < F.col("until_us"), F.lit(False)) & alive).drop("until_us", "failed_us")


def cache_fill_valid(reads: DataFrame, log: DataFrame, spans: DataFrame, failures: DataFrame, width_us: int) -> DataFrame:
    """Adds ``valid``: ready at both ends of the fill, the same consumer generation, and no data record
    in between. ``reads(consumer, generation, begin_us, store_generation, store_us)``; ``log`` is accepted."""
    revisions = running(
        log.where(F.col("kind") == "data").groupBy("consumer", "now_us").agg(F.count("*").alias("_n")),
        ["consumer"], "now_us", {"_rev": ("sum", F.col("_n"))}, width_us * 1024, inclusive=True,
    ).select("consumer", "now_us", "_rev")

    def at(frame: DataFrame, time: str, name: str) -> DataFrame:
        right = revisions.withColumnRenamed("_rev", name)
        found = asof_lookup(frame, right, ["consumer"], time, "now_us", [name], width_us, strict=False, backward=True)
        probe = found.withColumn("at_us", F.col(time))
        return ready_at(probe, spans, failures, width_us).withColumnRenamed("ready", f"{name}_ready").drop("at_us")

    both = at(at(reads, "begin_us", "_begin"), "store_us", "_store")
    same = F.coalesce(F.col("_begin"), F.lit(0)) == F.coalesce(F.col("_store"), F.lit(0))
    valid = same & F.col("_begin_ready") & F.col("_store_ready") & (F.col("generation") == F.col("store_generation"))
    return both.select(*reads.columns, valid.alias("valid"))


def retention_gap(committed: DataFrame, log: DataFrame) -> DataFrame:
    """Consumers whose next offset lies below the start of their log: records are lost, rebuild cold."""
    low = log.groupBy("consumer").agg(F.min("offset").alias("log_start"))
    return committed.join(low, "consumer").where(F.col("next_offset") < F.col("log_start"))


def managed_boundaries(marks: DataFrame, by: Sequence[str], order: str, width: int = 1 << 16) -> DataFrame:
    """Boundaries that count under at-least-once delivery: late older or equal ones are ignored."""
    seen = running(marks, by, order, {"_best": ("max", F.col("boundary_us"))}, width)
    return seen.where(F.col("_best").isNull() | (F.col("boundary_us") > F.col("_best"))).drop("_best")


def complete_prefix(log: DataFrame, expected: DataFrame, by: Sequence[str] = ("topic",)) -> DataFrame:
    """Per boundary whether all rows of its batch and no later row come before it.

    ``expected(by, tick_id, n)`` is what each batch holds on the route.
    """
    per_batch = log.groupBy(*by, "tick_id").agg(
        F.min(F.when(F.col("kind") == "boundary", F.col("offset"))).alias("boundary_offset"),
        F.max(F.when(F.col("kind") == "data", F.col("offset"))).alias("last_data"),
        F.count_if(F.col("kind") == "data").alias("delivered"),
    )
    joined = per_batch.where(F.col("boundary_offset").isNotNull()).join(expected, [*by, "tick_id"], "left")
    whole = (F.col("delivered") == F.coalesce(F.col("n"), F.lit(0))) & (
        F.col("last_data").isNull() | (F.col("last_data") < F.col("boundary_offset"))
    )
    return joined.select(*by, "tick_id", "boundary_offset", "delivered", whole.alias("complete"))


def prefix_before_poison(decoded: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Records that may already be out when a batch holds a poison record (all ids below the first bad
    one), and the batches that stay pending."""
    bad = decoded.where(F.col("reason").isNotNull()).groupBy(*by).agg(F.min("ev_id").alias("first_bad_id"))
    out = decoded.join(bad, list(by), "left").where(F.col("first_bad_id").isNull() | (F.col("ev_id") < F.col("first_bad_id")))
    return out.drop("first_bad_id"), bad

