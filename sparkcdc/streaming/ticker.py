"""The ticker as a stream: calls in, closed batches out, a row of state per queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TICKS = "queue string, tick_id bigint, at_us bigint, event_seq bigint"
STATE = "last_at bigint, last_seq bigint, gap bigint, number bigint"

#: What a ticker is told. Kinds, in the order in which those of one moment apply.
KINDS = ("queue", "force", "tick", "poll")
CALLS = "queue string, at_us bigint, kind string, event_seq bigint, tick_id bigint, max_count bigint, max_lag_us bigint, idle_us bigint, paused boolean, external boolean"
ANSWERS = TICKS + ", kind string, reason string"
QUEUE_STATE = STATE + ", forced boolean, max_count bigint, max_lag_us bigint, idle_us bigint, paused boolean, external boolean"


def waits(at_us, event_seq, last_at, last_seq, gap, max_count, max_lag_us, idle_us) -> bool:
    """Whether a poll leaves the open batch open, after a last tick at ``last_at`` that came ``gap`` after its own."""
    if last_at is None:
        return False
    age = at_us - last_at
    if event_seq > last_seq:
        return event_seq - last_seq < max_count and age < max_lag_us
    return gap is not None and (age * 2 < max_lag_us or (age < gap * 2 and age < idle_us))


def tick_stream(polls: DataFrame) -> DataFrame:
    """``polls(queue, at_us, event_seq, max_count, max_lag_us, idle_us)`` to ticks, by the rules of
    ``close_batches``. Polls of a queue must reach the stream in time order over its batches."""

    def step(key, frames, state):
        import pandas as pd

        last_at, last_seq, gap, number = state.get if state.exists else (None, None, None, 0)
        polls = pd.concat(list(frames)).sort_values("at_us")
        out = []
        for row in polls.itertuples(index=False):
            if waits(row.at_us, row.event_seq, last_at, last_seq, gap, row.max_count, row.max_lag_us, row.idle_us):
                continue
            gap = None if last_at is None else int(row.at_us - last_at)
            number += 1
            last_at, last_seq = int(row.at_us), int(row.event_seq)
            out.append((key[0], number, last_at, last_seq))
        state.update((last_at, last_seq, gap, number))
        yield pd.DataFrame(out, columns=["queue", "tick_id", "at_us", "event_seq"])

    return polls.groupBy("queue").applyInPandasWithState(step, TICKS, STATE, "append", "NoTimeout")


def ticker_stream(calls: DataFrame) -> DataFrame:
    """``calls`` (see ``CALLS``) to ticks and refusals: ``(queue, tick_id, at_us, event_seq, kind, reason)``.

    - ``queue`` creates a queue or changes it; a null setting keeps its value. A new queue is neither paused nor external.
    - ``poll`` ticks by the rules of ``close_batches``. Polls of a paused, an external or an unknown queue do nothing.
    - ``force`` makes the next poll that can tick do so, a pause in between notwithstanding. Refused for a queue that is
      unknown, paused or external.
    - ``tick`` is a tick of an external queue, with its id; ids must rise and event_seq must not fall, or it is refused. Polls
      go on counting from the last id when the queue is external no more.

    Calls apply in time order within a micro-batch and when they arrive beyond it: a setting holds from its arrival on,
    as it does in a queue that is polled live. Rows without queue or time, and of other kinds, are left out; a missing
    event_seq is the one of the last tick. What a queue is called with follows the clock, not the data.
    """
    # Nulls would turn a frame's integers into floats.
    none = -(1 << 63)
    numbers = ["event_seq", "tick_id", "max_count", "max_lag_us", "idle_us"]
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    usable = calls.where(F.col("queue").isNotNull() & F.col("at_us").isNotNull() & F.col("kind").isin(*KINDS))
    flags = [F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c) for c in ("paused", "external")]
    told = usable.select("queue", "at_us", "kind", rank.alias("rank"), *[F.coalesce(c, F.lit(none)).alias(c) for c in numbers], *flags)

    def step(key, frames, state):
        import pandas as pd

        unknown = (None, None, None, 0, False, None, None, None, None, None)
        last_at, last_seq, gap, number, forced, count, lag, idle, paused, external = state.get if state.exists else unknown
        out = []

        def answer(row, tick_id, seq, reason=None):
            out.append((key[0], tick_id, int(row.at_us), seq, row.kind, reason))

        for row in pd.concat(list(frames)).sort_values(["at_us", "rank", "tick_id"], kind="stable").itertuples(index=False):
            if row.kind == "queue":
                count, lag, idle = (old if new == none else int(new) for old, new in ((count, row.max_count), (lag, row.max_lag_us), (idle, row.idle_us)))
                paused, external = (bool(old) if new < 0 else bool(new) for old, new in ((paused, row.paused), (external, row.external)))
                continue
            seq = (last_seq or 0) if row.event_seq == none else int(row.event_seq)
            offered = None if row.tick_id == none else int(row.tick_id)
            if row.kind == "poll":
                if paused is None or paused or external or None in (count, lag, idle):
                    continue
                if not forced and waits(row.at_us, seq, last_at, last_seq, gap, count, lag, idle):
                    continue
                offered, forced = number + 1, False
            else:
                reason = "queue not found" if paused is None else "paused" if paused else None
                if row.kind == "force":
                    reason = reason or ("external" if external else None)
                    forced = forced or reason is None
                else:
                    reason = reason or ("not external" if not external else None)
                    reason = reason or ("tick id not rising" if offered is None or offered <= number else None)
                    reason = reason or ("event seq falls" if last_seq is not None and seq < last_seq else None)
                if reason is not None:
                    answer(row, offered, seq if row.kind == "tick" else None, reason)
                if reason is not None or row.kind == "force":
                    continue
            gap = None if last_at is None else int(row.at_us - last_at)
            number, last_at, last_seq = offered, int(row.at_us), seq
            answer(row, number, seq)
        state.update((last_at, last_seq, gap, number, forced, count, lag, idle, paused, external))
        if out:
            frame = pd.DataFrame(out, columns=["queue", "tick_id", "at_us", "event_seq", "kind", "reason"])
            yield frame.astype({"tick_id": "Int64", "event_seq": "Int64"})

    return told.groupBy("queue").applyInPandasWithState(step, ANSWERS, QUEUE_STATE, "append", "NoTimeout")
