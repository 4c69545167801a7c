"""Greedy cutting of ordered rows into segments, in parallel over blocks.

A segment starts at a row and takes rows until a limit relative to its start would be passed;
the next row starts the next segment. Where a segment starts depends on all rows before it, yet
the sequence need not be read by one task: for a block of rows, everything the past can change is
where the first start inside the block falls, and only rows within one limit of the block's
beginning qualify. Each block is summed up as "first start at k -> state left behind", those
summaries compose, and a second pass over the blocks places the starts once the state that
enters each block is known.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """A quantity along the sequence. ``running`` adds the column up from the segment start and cuts
    when the sum passes ``limit``; otherwise the column itself (a time) is compared to its value at
    the start. ``column`` must be integer, and not fall along the order (or not be negative)."""

    column: str
    limit: int
    running: bool


def _axes(frame: dict, measures: Sequence[Measure]):
    """Per measure: end and start coordinate of each row, and how far the block moves the origin."""
    ends, starts, totals = [], [], []
    for m in measures:
        values = np.asarray(frame[m.column], dtype=np.int64)
        if m.running:
            end = np.cumsum(values)
            ends.append(end)
            starts.append(end - values)
            totals.append(int(end[-1]) if len(end) else 0)
        else:
            ends.append(values)
            starts.append(values)
            totals.append(0)
    return ends, starts, totals


def _first_cut(ends, state, measures) -> np.ndarray:
    """Index of the first row beyond a limit for segments that started at ``state``."""
    cuts = [np.searchsorted(e, s + m.limit, side="right") for e, s, m in zip(ends, state, measures)]
    return np.minimum.reduce(cuts)


def _following(ends, starts, measures) -> np.ndarray:
    """For each row, where the next segment starts when one starts here."""
    n = len(ends[0])
    return np.maximum(_first_cut(ends, starts, measures), np.arange(1, n + 1))


def _chains(after) -> tuple[np.ndarray, np.ndarray]:
    """For each row the last start of the chain that begins there, and how many starts the chain has. Every round
    follows twice as many links as the one before."""
    n = len(after)
    ahead = np.append(after, n)
    last, count = np.arange(n + 1), np.append(np.ones(n, dtype=np.int64), 0)
    open_ = np.flatnonzero(ahead < n)
    while len(open_):
        to = ahead[open_]
        last[open_], more, ahead_of = last[to], count[to], ahead[to]
        count[open_] += more
        ahead[open_] = ahead_of
        open_ = open_[ahead_of < n]
    return last[:n], count[:n]


class _Summary:
    """What a run of rows does to the open segment: candidates for the first start and, for each,
    the state left at the end (relative to the end) and the number of starts."""

    def __init__(self, ends, exits, counts, totals, first):
        self.ends, self.exits, self.counts, self.totals, self.first = ends, exits, counts, totals, first

    @classmethod
    def of_rows(cls, frame, measures):
        ends, starts, totals = _axes(frame, measures)
        n = len(ends[0])
        after = _following(ends, starts, measures)
        last, count = _chains(after)
        keep = min(n, int(after[0]) + 1)
        exits = [s[last[:keep]] - t for s, t in zip(starts, totals)]
        return cls([e[:keep] for e in ends], exits, count[:keep], totals, [int(s[0]) for s in starts])

    def apply(self, state, measures):
        k = _first_cut(self.ends, state, measures)
        hit = k < len(self.counts)
        at = np.where(hit, k, 0)
        exits = [np.where(hit, e[at], s - t) for e, s, t in zip(self.exits, state, self.totals)]
        return exits, np.where(hit, self.counts[at], 0)

    def then(self, other, measures):
        exits, more = self.apply_tail(other, measures)
        counts = self.counts + more
        ends = self.ends
        if not self._closed(measures):
            # Every candidate so far lies within one limit of the first row: later rows qualify too.
            ends = [np.concatenate([e, o + (t if m.running else 0)]) for e, o, t, m in zip(ends, other.ends, self.totals, measures)]
            exits = [np.concatenate([e, o]) for e, o in zip(exits, other.exits)]
            counts = np.concatenate([counts, other.counts])
        totals = [a + b for a, b in zip(self.totals, other.totals)]
        merged = _Summary(ends, exits, counts, totals, self.first)
        return merged._trimmed(measures)

    def apply_tail(self, other, measures):
        return other.apply(self.exits, measures)

    def _beyond(self, measures):
        return int(_first_cut(self.ends, [np.array([s]) for s in self.first], measures)[0])

    def _closed(self, measures):
        return self._beyond(measures) < len(self.counts)

    def _trimmed(self, measures):
        keep = min(len(self.counts), self._beyond(measures) + 1)
        return _Summary([e[:keep] for e in self.ends], [e[:keep] for e in self.exits], self.counts[:keep], self.totals, self.first)

    def row(self) -> dict:
        out = {"_counts": self.counts.tolist()}
        for i in range(len(self.totals)):
            out[f"_e{i}"] = self.ends[i].tolist()
            out[f"_x{i}"] = self.exits[i].tolist()
            out[f"_t{i}"] = self.totals[i]
            out[f"_f{i}"] = self.first[i]
        return out

    @classmethod
    def of_row(cls, row, width):
        def arr(v):
            return np.asarray(v, dtype=np.int64)

        return cls(
            [arr(row[f"_e{i}"]) for i in range(width)],
            [arr(row[f"_x{i}"]) for i in range(width)],
            arr(row["_counts"]),
            [int(row[f"_t{i}"]) for i in range(width)],
            [int(row[f"_f{i}"]) for i in range(width)],
        )


def _groups(frames, keys: Sequence[str]):
    """``(key, columns)`` for each run of equal keys in sorted Arrow batches; one run may span batches.
    Yields ``None`` at the end of each batch, a point where output may be handed over."""
    key, held = None, None
    for frame in frames:
        if len(frame):
            columns = {c: frame[c].to_numpy() for c in frame.columns}
            change = np.zeros(len(frame), dtype=bool)
            for k in keys:
                change[1:] |= columns[k][1:] != columns[k][:-1]
            bounds = [0, *np.flatnonzero(change).tolist(), len(frame)]
            for lo, hi in zip(bounds, bounds[1:]):
                part = {c: v[lo:hi] for c, v in columns.items()}
                here = tuple(v[lo] for v in (columns[k] for k in keys))
                if held is not None and here == key:
                    held = {c: np.concatenate([held[c], part[c]]) for c in held}
                    continue
                if held is not None:
                    yield key, held
                key, held = here, part
        yield None
    if held is not None:
        yield key, held
    yield None


def _joined(pieces: list):
    if all(isinstance(p, np.ndarray) for p in pieces):
        return np.concatenate(pieces)
    return [x for p in pieces for x in p]


def _per_group(keys: Sequence[str], work, columns: Sequence[str], whole: Sequence[str] = ()):
    """A ``mapInPandas`` function that applies ``work(key, columns)`` to each run of equal keys.
    ``work`` returns a dict of equally long sequences."""

    def run(frames):
        out = []
        for item in _groups(frames, keys):
            if item is not None:
                out.append(work(*item))
            elif out:
                merged = {c: _joined([part[c] for part in out]) for c in columns}
                result = pd.DataFrame(merged, columns=list(columns))
                for c in whole:
                    result[c] = result[c].astype("Int64")
                yield result
                out = []

    return run


def greedy_cuts(
    df: DataFrame, by: Sequence[str], order: str, measures: Sequence[Measure], name: str = "segment", width: int = 65536, fan: int = 64
) -> DataFrame:
    """Adds ``name``, the 1-based number of the segment of each row, and ``<name>_start``, whether the
    row starts one.

    ``order`` is a non-negative integer column, unique per key; rows within ``width`` of it form a block,
    ``fan`` blocks a group. A task holds one block, or the summaries of one group, at a time; the
    groups of one key (a 4-millionth of its rows) are read in order as a stream.
    """
    by, measures = list(by), list(measures)
    m = len(measures)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = [*by, order, *dict.fromkeys(x.column for x in measures if x.column not in (order, *by))]
    blocks = df.select(*needed, F.floor(F.col(order) / width).cast("bigint").alias("_blk"))
    # Both passes over the blocks, and both over their summaries, read one shuffle each.
    blocks = blocks.repartition(tasks, *by, "_blk")
    ddl = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields}
    key_ddl = "".join(ddl[k] + ", " for k in by)
    parts = [f"_{p}{i}" for i in range(m) for p in "ex"]
    marks = [f"_{p}{i}" for i in range(m) for p in "tf"]
    summary = ["_counts", *parts, *marks]
    summary_ddl = ", ".join(f"{c} {'bigint' if c in marks else 'array<bigint>'}" for c in summary)
    states = [f"_s{i}" for i in range(m)]
    state_ddl = "_before bigint, " + ", ".join(f"{s} bigint" for s in states)

    def laid_out(rows: DataFrame, keys: Sequence[str], *within: str) -> DataFrame:
        # A fixed number of tasks: the work is Python, which small-partition coalescing would serialise.
        return rows.repartition(tasks, *keys).sortWithinPartitions(*keys, *within)

    def single(keys, key, row: dict) -> dict:
        return {**{k: [v] for k, v in zip(keys, key)}, **{c: [v] for c, v in row.items()}}

    def summarise(key, columns):
        return single([*by, "_blk"], key, _Summary.of_rows(columns, measures).row())

    leaves = blocks.sortWithinPartitions(*by, "_blk", order).mapInPandas(
        _per_group([*by, "_blk"], summarise, [*by, "_blk", *summary]), f"{key_ddl}_blk bigint, {summary_ddl}"
    )
    leaves = leaves.withColumn("_grp", F.floor(F.col("_blk") / fan).cast("bigint")).repartition(tasks, *by, "_grp")

    def summaries(columns):
        for i in range(len(columns["_counts"])):
            yield _Summary.of_row({c: columns[c][i] for c in summary}, m)

    def combine(key, columns):
        whole = None
        for part in summaries(columns):
            whole = part if whole is None else whole.then(part, measures)
        return single([*by, "_grp"], key, whole.row())

    groups = leaves.sortWithinPartitions(*by, "_grp", "_blk").mapInPandas(
        _per_group([*by, "_grp"], combine, [*by, "_grp", *summary]), f"{key_ddl}_grp bigint, {summary_ddl}"
    )

    def advance(state, before, part):
        """The state after ``part``; without a state the part's first row starts the first segment."""
        if state is None:
            return [x[:1] for x in part.exits], before + int(part.counts[0])
        state, counts = part.apply(state, measures)
        return state, before + int(counts[0])

    def noted(state, before) -> dict:
        return {"_before": None if state is None else before, **{s: None if state is None else int(state[i][0]) for i, s in enumerate(states)}}

    def stream(frames):
        key, state, before = None, None, 0
        for frame in frames:
            out = []
            columns = {c: frame[c].to_numpy() for c in frame.columns}
            for i, part in enumerate(summaries(columns)):
                here = tuple(columns[k][i] for k in by)
                if here != key:
                    key, state, before = here, None, 0
                out.append({**dict(zip(by, here)), "_grp": columns["_grp"][i], **noted(state, before)})
                state, before = advance(state, before, part)
            result = pd.DataFrame(out, columns=[*by, "_grp", "_before", *states])
            for c in ["_before", *states]:
                result[c] = result[c].astype("Int64")
            yield result

    in_order = laid_out(groups, by, "_grp") if by else groups.coalesce(1).sortWithinPartitions("_grp")
    group_entry = in_order.mapInPandas(stream, f"{key_ddl}_grp bigint, {state_ddl}")

    def known(columns):
        before = columns["_before"][0]
        if before is None or pd.isna(before):
            return None, 0
        return [np.array([int(columns[s][0])]) for s in states], int(before)

    def down(key, columns):
        state, before = known(columns)
        rows = []
        for blk, part in zip(columns["_blk"], summaries(columns)):
            rows.append({**dict(zip(by, key)), "_blk": blk, **noted(state, before)})
            state, before = advance(state, before, part)
        return {c: [r[c] for r in rows] for c in [*by, "_blk", "_before", *states]}

    leaf_entry = laid_out(leaves.join(group_entry, [*by, "_grp"]), [*by, "_grp"], "_blk").mapInPandas(
        _per_group([*by, "_grp"], down, [*by, "_blk", "_before", *states], ["_before", *states]), f"{key_ddl}_blk bigint, {state_ddl}"
    )

    def place(key, columns):
        ends, starts, _ = _axes(columns, measures)
        after = _following(ends, starts, measures)
        state, before = known(columns)
        k = 0 if state is None else int(_first_cut(ends, state, measures)[0])
        flags, links = np.zeros(len(after), dtype=bool), after.tolist()
        starts_at = []
        while k < len(links):
            starts_at.append(k)
            k = links[k]
        flags[starts_at] = True
        return {**{c: columns[c] for c in needed}, name: before + np.cumsum(flags), f"{name}_start": flags}

    placed_ddl = ", ".join(ddl[c] for c in needed) + f", {name} bigint, {name}_start boolean"
    placed = laid_out(blocks.join(leaf_entry, [*by, "_blk"]), [*by, "_blk"], order).mapInPandas(
        _per_group([*by, "_blk"], place, [*needed, name, f"{name}_start"]), placed_ddl
    )
    if all(c in needed for c in df.columns):
        return placed
    return df.join(placed.select(*by, order, name, f"{name}_start"), [*by, order])
