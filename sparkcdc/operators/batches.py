"""Batches: which events each closed batch holds, decided by transaction visibility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcdc.functions.snapshot import visible
from sparkcdc.operators.ordered import asof_lookup


def late_transactions(ticks: DataFrame, by: Sequence[str] = (), width: int = 64) -> DataFrame:
    """``(by, txid, late_tick)``: transactions that were running at some tick, with the first tick
    after the last one that still listed them (null while there is none yet)."""
    by = list(by)
    last_open = (
        ticks.select(*by, "tick_id", F.explode("xip").alias("txid")).groupBy(*by, "txid").agg(F.max("tick_id").alias("_open"))
    )
    following = ticks.select(*by, F.col("tick_id").alias("_at"), F.col("tick_id").alias("late_tick"))
    return asof_lookup(last_open, following, by, "_open", "_at", ["late_tick"], width).select(
        *by, "txid", F.lit(True).alias("_was_open"), "late_tick"
    )


def assign_batches(events: DataFrame, ticks: DataFrame, by: Sequence[str] = (), width: int = 1024) -> DataFrame:
    """Adds ``batch_tick``: the first tick whose snapshot sees the event's transaction.

    A transaction that was never listed as running is seen by the first tick whose xmax lies
    above it; a listed one by the first tick after the last that listed it. Both lookups are equi
    joins against tables the size of the tick log, so events are read once and are not shuffled
    when those tables fit a broadcast. Events no tick sees yet keep a null ``batch_tick``.
    """
    by = list(by)
    seen = asof_lookup(
        events, ticks.select(*by, "xmax", F.col("tick_id").alias("_tick")), by, "ev_txid", "xmax", ["_tick"], width
    )
    late = late_transactions(ticks, by).withColumnRenamed("txid", "ev_txid")
    joined = seen.join(late, [*by, "ev_txid"], "left")
    return joined.select(
        *events.columns, F.when(F.col("_was_open"), F.col("late_tick")).otherwise(F.col("_tick")).alias("batch_tick")
    )


def tick_pairs(ticks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each tick with its predecessor's snapshot as ``last_*``."""
    # Ticks of one queue follow the clock, not the data; their pairing is a plain lag.
    order = Window.partitionBy(*by).orderBy("tick_id")
    names = ["tick_id", "xmin", "xmax", "xip", "tick_time", "event_seq"]
    lagged = [F.lag(c).over(order).alias(f"last_{c}") for c in names]
    return ticks.select(*by, *names, *lagged).where(F.col("last_tick_id").isNotNull())


def tx_ranges(pairs: DataFrame, near: int = 100) -> DataFrame:
    """Per tick pair the transaction range to scan and the exact ids below it.

    Transactions that ended between the ticks are taken from high to low; while the next one is
    within ``near`` of the current start the range is stretched down to it, the others are listed.
    """
    ended = F.sort_array(F.array_except("last_xip", "xip"), asc=False)
    folded = F.aggregate(
        ended,
        F.struct(F.col("last_xmax").alias("start"), F.array().cast("array<bigint>").alias("others")),
        lambda acc, x: F.when(
            acc["start"] - near <= x, F.struct(x.alias("start"), acc["others"].alias("others"))
        ).otherwise(F.struct(acc["start"].alias("start"), F.array_append(acc["others"], x).alias("others"))),
    )
    return pairs.withColumn("_f", folded).select(
        *[c for c in pairs.columns],
        F.col("_f")["start"].alias("tx_start"),
        F.col("xmax").alias("tx_end"),
        F.col("_f")["others"].alias("tx_list"),
    )


def batch_events(events: DataFrame, last: dict, cur: dict, sub_id: int | None = None) -> DataFrame:
    """Events of one batch: seen by ``cur``, not by ``last``; retries only for their owner.

    The two snapshots are given as dicts with ``xmin, xmax, xip`` so that the transaction range
    and list reach the scan as literals.
    """
    low, listed = cur_range(last, cur)
    txid = F.col("ev_txid")
    inside = txid.between(low, cur["xmax"])
    if listed:
        inside = inside | txid.isin(listed)

    def sees(snap: dict):
        xip = F.array(*[F.lit(x).cast("bigint") for x in snap["xip"]]) if snap["xip"] else F.array().cast("array<bigint>")
        return visible(txid, F.lit(snap["xmin"]), F.lit(snap["xmax"]), xip)

    rows = events.where(inside & sees(cur) & ~sees(last))
    if sub_id is not None:
        rows = rows.where(F.col("ev_owner").isNull() | (F.col("ev_owner") == sub_id))
    return rows.orderBy("ev_id")


def cur_range(last: dict, cur: dict, near: int = 100) -> tuple[int, list[int]]:
    """The literal form of ``tx_ranges`` for one pair of snapshots held by the caller."""
    low, listed = last["xmax"], []
    for x in sorted(set(last["xip"]) - set(cur["xip"]), reverse=True):
        if low - near <= x:
            low = x
        else:
            listed.append(x)
    return low, listed


def window_events(assigned: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Events of every subscription's open window ``(last_tick, next_tick]`` at once.

    ``assigned`` carries ``batch_tick``; the pairs are joined on (queue, tick) after each window
    is spelled out as the ticks it spans, which keeps it an equi join. Retries reach only
    their owner.
    """
    spans = subscriptions.where(F.col("next_tick").isNotNull()).select(
        "queue", "sub_id", "batch_id", F.explode(F.sequence(F.col("last_tick") + 1, F.col("next_tick"))).alias("batch_tick")
    )
    joined = assigned.join(spans, ["queue", "batch_tick"])
    return joined.where(F.col("ev_owner").isNull() | (F.col("ev_owner") == F.col("sub_id")))


def batch_cursor(rows: DataFrame, limit: int, where: str | None = None) -> DataFrame:
    """The first ``limit`` events of a batch in id order, after an optional filter."""
    if where is not None:
        rows = rows.where(F.expr(where))
    return rows.orderBy("ev_id").limit(limit)


def next_batch(subscriptions: DataFrame, ticks: DataFrame, now=None, min_lag_seconds: float | None = None, width: int = 64) -> DataFrame:
    """The window each subscription reads next: its open one again, else up to the tick that
    follows its cursor, unless that tick is younger than ``min_lag_seconds``."""
    found = asof_lookup(
        subscriptions,
        ticks.select("queue", F.col("tick_id").alias("_at"), F.col("tick_id").alias("_next"), F.col("tick_time").alias("_time")),
        ["queue"],
        "last_tick",
        "_at",
        ["_next", "_time"],
        width,
    )
    usable = F.col("_next")
    if min_lag_seconds is not None:
        young = F.unix_micros("_time") > F.unix_micros(F.lit(now).cast("timestamp")) - int(min_lag_seconds * 1_000_000)
        usable = F.when(~young, usable)
    is_open = F.col("batch_id").isNotNull()
    return found.select(
        "queue",
        "sub_id",
        F.col("last_tick").alias("prev_tick"),
        F.when(is_open, F.col("next_tick")).otherwise(usable).alias("cur_tick"),
        is_open.alias("reopened"),
    )


def find_tick(
    subscriptions: DataFrame,
    ticks: DataFrame,
    min_count: int | None,
    min_interval_us: int | None,
    seq_width: int = 1024,
    time_width_us: int = 600_000_000,
) -> DataFrame:
    """Tick to read up to when a batch should be large: the newest tick if it meets an ask and
    is not over twice any; if it is over twice, the first tick meeting an ask; else none.

    Sequence and time never fall along the ticks of a queue, so "first tick meeting an ask" is one
    as-of lookup per ask and no subscription is paired with every tick.
    """
    cursor = ticks.select(
        "queue", F.col("tick_id").alias("last_tick"), F.unix_micros("tick_time").alias("_t0"), F.col("event_seq").alias("_s0")
    )
    newest = ticks.groupBy("queue").agg(F.max(F.struct("tick_id", "event_seq", F.unix_micros("tick_time").alias("t"))).alias("_new"))
    subs = subscriptions.select("queue", "sub_id", "last_tick").join(cursor, ["queue", "last_tick"]).join(newest, "queue")
    count, age = F.col("_new")["event_seq"] - F.col("_s0"), F.col("_new")["t"] - F.col("_t0")
    meets, over, firsts = F.lit(False), F.lit(False), []
    if min_count is not None:
        meets, over = meets | (count >= min_count), over | (count > 2 * min_count)
        subs = subs.withColumn("_need", F.col("_s0") + min_count)
        right = ticks.select("queue", "event_seq", F.col("tick_id").alias("_by_count"))
        subs = asof_lookup(subs, right, ["queue"], "_need", "event_seq", ["_by_count"], seq_width, strict=False)
        firsts.append(F.col("_by_count"))
    if min_interval_us is not None:
        meets, over = meets | (age >= min_interval_us), over | (age > 2 * min_interval_us)
        subs = subs.withColumn("_need", F.col("_t0") + min_interval_us)
        right = ticks.select("queue", F.unix_micros("tick_time").alias("_us"), F.col("tick_id").alias("_by_time"))
        subs = asof_lookup(subs, right, ["queue"], "_need", "_us", ["_by_time"], time_width_us, strict=False)
        firsts.append(F.col("_by_time"))
    first = F.least(*firsts) if len(firsts) > 1 else (firsts[0] if firsts else F.lit(None).cast("bigint"))
    behind = F.col("_new")["tick_id"] > F.col("last_tick")
    choice = F.when(behind & over, first).when(behind & meets, F.col("_new")["tick_id"])
    found = subs.select("queue", "sub_id", choice.alias("found_tick"))
    return subscriptions.select("queue", "sub_id").join(found, ["queue", "sub_id"], "left")


def receive(subscriptions: DataFrame, ticks: DataFrame, assigned: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Open the next window of each subscription and return its first ``limit`` events in id
    order, with the moved cursors as a second frame. A window without events is finished at once.

    Acknowledging later finishes the whole window, so a prefix read can lose the rest.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    opened = next_batch(subscriptions, ticks).where(F.col("cur_tick").isNotNull())
    span = F.sequence(F.col("prev_tick") + 1, F.col("cur_tick"))
    spans = opened.select("queue", "sub_id", F.lit(0).alias("batch_id"), F.explode(span).alias("batch_tick"))
    # What everybody reads is cut to its first rows and counted per batch before it meets any subscription;
    # a retry meets its owner only.
    common = assigned.where(F.col("ev_owner").isNull() & F.col("batch_tick").isNotNull())
    heads = take_first(common, ["queue", "batch_tick"], "ev_id", limit)
    totals = common.groupBy("queue", "batch_tick").agg(F.count("*").alias("_n"))
    own = assigned.where(F.col("ev_owner").isNotNull()).withColumn("sub_id", F.col("ev_owner")).join(spans, ["queue", "batch_tick", "sub_id"])
    rows = heads.join(spans, ["queue", "batch_tick"]).unionByName(own)
    ranked = take_first(rows, ["queue", "sub_id"], "ev_id", limit)
    both = spans.join(totals, ["queue", "batch_tick"]).select("queue", "sub_id", "_n").unionByName(own.select("queue", "sub_id", F.lit(1).cast("bigint").alias("_n")))
    counts = both.groupBy("queue", "sub_id").agg(F.sum("_n").alias("_n"))
    cursors = opened.join(counts, ["queue", "sub_id"], "left").select(
        "queue",
        "sub_id",
        F.when(F.col("_n") > 0, F.col("prev_tick")).otherwise(F.col("cur_tick")).alias("last_tick"),
        F.when(F.col("_n") > 0, F.col("cur_tick")).alias("next_tick"),
        F.coalesce(F.col("_n"), F.lit(0)).alias("in_batch"),
    )
    return ranked, cursors


def take_first(df: DataFrame, by: Sequence[str], order: str, limit: int, salt: int = 64) -> DataFrame:
    """First ``limit`` rows per key in order, ranked in two steps so that a hot key is first cut
    down inside ``salt`` slices."""
    slices = Window.partitionBy(*by, "_s").orderBy(order)
    whole = Window.partitionBy(*by).orderBy(order)
    sliced = df.withColumn("_s", F.pmod(F.xxhash64(F.col(order)), F.lit(salt)))
    few = sliced.withColumn("_r", F.row_number().over(slices)).where(F.col("_r") <= limit)
    return few.withColumn("_r", F.row_number().over(whole)).where(F.col("_r") <= limit).drop("_r", "_s")


def ack_batch(subscriptions: DataFrame, batches: DataFrame) -> DataFrame:
    """Finish the named batches: the cursor moves to the end of the window and the batch closes.
    Adds ``acked``; batch ids nobody holds change nothing."""
    done = batches.select("batch_id").distinct().withColumn("_done", F.lit(True))
    joined = subscriptions.join(done, "batch_id", "left")
    acked = F.coalesce(F.col("_done"), F.lit(False))
    return joined.select(
        "queue",
        "sub_id",
        F.when(acked, F.col("next_tick")).otherwise(F.col("last_tick")).alias("last_tick"),
        F.when(~acked, F.col("next_tick")).alias("next_tick"),
        F.when(~acked, F.col("batch_id")).alias("batch_id"),
        acked.alias("acked"),
    )


def subscribe(subscriptions: DataFrame, requests: DataFrame, ticks: DataFrame) -> DataFrame:
    """Register ``requests(queue, sub_id, at_tick)``.

    A new subscription starts at the given tick, else at the newest one. A known one is moved
    (and its open batch dropped) only when a tick is given. A tick that does not exist, or a queue
    without ticks, gives a reason and no change.
    """
    newest = ticks.groupBy("queue").agg(F.max("tick_id").alias("_newest"))
    known_ticks = ticks.select("queue", F.col("tick_id").alias("at_tick"), F.lit(True).alias("_known")).distinct()
    asked = (
        requests.join(newest, "queue", "left")
        .join(known_ticks, ["queue", "at_tick"], "left")
        .withColumn("_asked", F.lit(True))
    )
    merged = subscriptions.join(asked, ["queue", "sub_id"], "full_outer")
    existing = F.col("last_tick").isNotNull()
    reason = F.when(F.col("_asked") & F.col("at_tick").isNotNull() & F.col("_known").isNull(), F.lit("tick not found")).when(
        F.col("_asked") & ~existing & F.col("at_tick").isNull() & F.col("_newest").isNull(), F.lit("no ticks")
    )
    move = F.col("_asked") & reason.isNull() & F.col("at_tick").isNotNull()
    move = F.coalesce(move, F.lit(False))
    return merged.select(
        "queue",
        "sub_id",
        F.when(move, F.col("at_tick"))
        .when(existing, F.col("last_tick"))
        .when(reason.isNull(), F.col("_newest"))
        .alias("last_tick"),
        F.when(existing & ~move, F.col("next_tick")).alias("next_tick"),
        F.when(existing & ~move, F.col("batch_id")).alias("batch_id"),
        reason.alias("reason"),
    )


def unsubscribe(
    subscriptions: DataFrame, retries: DataFrame, dead_letters: DataFrame, leaving: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Remove ``leaving(queue, consumer)``: cursors, the retry rows they own, and the dead letters of
    consumers that keep no other subscription."""
    gone = leaving.select("queue", "consumer").distinct()
    kept = subscriptions.join(gone, ["queue", "consumer"], "left_anti")
    dropped = subscriptions.join(gone, ["queue", "consumer"], "left_semi")
    kept_retries = retries.join(dropped.select("queue", F.col("sub_id").alias("ev_owner")), ["queue", "ev_owner"], "left_anti")
    homeless = gone.select("consumer").distinct().join(kept, "consumer", "left_anti")
    return kept, kept_retries, dead_letters.join(homeless, "consumer", "left_anti")


def fetch_size(assigned: DataFrame, batch: int, batch_bytes: int, by: Sequence[str] = ("batch_tick",)) -> DataFrame:
    """Rows to fetch per page of each batch, bounded by rows and by its largest payload."""
    largest = assigned.groupBy(*by).agg(F.coalesce(F.max(F.octet_length("ev_data")), F.lit(0)).cast("bigint").alias("max_bytes"))
    pages = F.expr(f"{batch_bytes} div greatest(1L, max_bytes)")
    return largest.withColumn("fetch_rows", F.least(F.lit(batch).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), pages)))


def drain_batch(assigned: DataFrame, ticks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per tick how many events its batch holds, empty batches included, with the id range."""
    by = list(by)
    totals = (
        assigned.where(F.col("batch_tick").isNotNull())
        .groupBy(*by, F.col("batch_tick").alias("tick_id"))
        .agg(F.count("*").alias("n"), F.min("ev_id").alias("first_id"), F.max("ev_id").alias("last_id"))
    )
    return ticks.select(*by, "tick_id").join(totals, [*by, "tick_id"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
