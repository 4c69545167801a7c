"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of 64 bits is cut into m segments, each with an index of its values. A query looks up every value
within radius r of its own segments, r = 0, 1, ..., and verifies what it finds. Codes within m * (r + 1) - 1
bits have then all been found, so a query is done when its k-th verified distance is no larger. Where a radius
would probe more values than there are codes, the rest of that query reads the codes themselves.

Equal codes are one entry with their k + 1 least ids, however many rows share them. Codes are dealt into blocks and
queries into chunks of bounded size; every chunk meets every block, and the blocks' answers are merged.

Nulls and ties: a row without a vector, with a null inside it or without an id is neither found nor answered.
Of equal distances the least id comes first. A query does not find its own id. An id with several codes is one
neighbour, at the least of its distances, and one query, nearest to what is nearest to any of its codes. Fewer ids
than k give fewer neighbours, an empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, islice
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcdc.llm.common import written

BITS = 64
K = 10
BLOCK_CODES = 1 << 16
CHUNK_QUERIES = 1 << 12
_TOGETHER = 128


def sign_codes(vectors: DataFrame, key: str, vector: str, seed: int = 5) -> DataFrame:
    """``id`` and ``code``: the signs of 64 random projections, null where there is no vector."""
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            codes: list[int | None] = []
            lists = batch.column(1)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for a, b in zip(ends.tolist(), ends[1:].tolist()):
                v = flat[a:b]
                if not len(v) or np.isnan(v).any():
                    codes.append(None)
                    continue
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng([seed, len(v)]).normal(size=(BITS, len(v)))
                signs = np.packbits(planes[len(v)] @ v > 0, bitorder="little")
                codes.append(int(signs.view(np.int64)[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.int64())], ["id", "code"])

    return rows.mapInArrow(run, "id bigint, code bigint").where("code IS NOT NULL").distinct()


class Index:
    """Multi-index hashing over one block of distinct codes, each with its ids in ascending order."""

    def __init__(self, codes: np.ndarray, ids: list):
        self.codes = codes
        self.counts = np.fromiter(map(len, ids), np.int64, len(ids))
        self.flat = np.fromiter(chain.from_iterable(ids), np.int64, int(self.counts.sum()))
        self.starts = np.cumsum(self.counts) - self.counts
        self.least = self.flat[self.starts]
        self.repeats = len(np.unique(self.flat)) < len(self.flat)
        width = min(20, max(1, int(np.log2(max(2, len(codes))))))
        m = max(1, round(BITS / width))
        cuts = [BITS * i // m for i in range(m + 1)]
        self.segments = [(np.uint64(a), np.uint64((1 << (b - a)) - 1), b - a) for a, b in zip(cuts, cuts[1:])]
        self.tables = []
        for low, mask, _ in self.segments:
            values = (codes >> low) & mask
            order = np.argsort(values, kind="stable")
            self.tables.append((values[order], order))

    def _best(self, found: list[list[np.ndarray]], queries: np.ndarray, k: int):
        """Per query the codes that hold its ``k`` best ids, and the distance at which ``k`` ids are reached."""
        out, reached = [], []
        for q, parts in zip(queries, found):
            at = np.concatenate(parts) if parts else np.empty(0, np.int64)
            far = np.bitwise_count(self.codes[at] ^ q).astype(np.int64)
            if self.repeats:
                kept, last = self._distinct(at, far, k)
                out.append(kept)
                reached.append(last)
                continue
            order = np.lexsort((self.least[at], far))[:k]
            at, far = at[order], far[order]
            enough = np.flatnonzero(np.cumsum(self.counts[at]) >= k)
            reached.append(int(far[enough[0]]) if len(enough) else BITS + 1)
            out.append(at)
        return out, np.array(reached)

    def listed(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these codes, and for each which of the codes it is of."""
        lengths = self.counts[at]
        shift = self.starts[at] - (np.cumsum(lengths) - lengths)
        return self.flat[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)], np.repeat(np.arange(len(at)), lengths)

    def _distinct(self, at: np.ndarray, far: np.ndarray, k: int) -> tuple[np.ndarray, int]:
        """As ``_best`` for one query where an id has several codes: it counts where it is nearest."""
        ids, owner = self.listed(at)
        order = np.lexsort((ids, far[owner]))
        order = order[np.sort(np.unique(ids[order], return_index=True)[1])[:k]]
        last = int(far[owner[order[-1]]]) if len(order) >= k else BITS + 1
        return at[np.unique(owner[order])], last

    def search(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """Positions of the codes that hold the ``k`` nearest ids of each query."""
        out: list[np.ndarray] = []
        for start in range(0, len(queries), _TOGETHER):
            out += self._search(queries[start : start + _TOGETHER], k)
        return out

    def _search(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        m = len(self.segments)
        best: list[np.ndarray] = [np.empty(0, np.int64) for _ in queries]
        open_ = np.arange(len(queries))
        for radius in range(max(w for _, _, w in self.segments) + 1):
            if not len(open_):
                break
            if sum(comb(w, radius) for _, _, w in self.segments) > len(self.codes):
                every = np.arange(len(self.codes))
                rest, _ = self._best([[every] for _ in open_], queries[open_], k)
                for i, at in zip(open_.tolist(), rest):
                    best[i] = at
                break
            found: list[list[np.ndarray]] = [[best[i]] for i in open_]
            for s, (low, mask, width) in enumerate(self.segments):
                if radius > width:
                    continue
                flips = np.array([sum(1 << b for b in bits) for bits in combinations(range(width), radius)], np.uint64)
                values, order = self.tables[s]
                probes = ((queries[open_] >> low) & mask)[:, None] ^ flips
                first, last = np.searchsorted(values, probes, "left"), np.searchsorted(values, probes, "right")
                sizes = (last - first).ravel()
                total = int(sizes.sum())
                if not total:
                    continue
                at = order[np.repeat(first.ravel() - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)]
                who = np.repeat(np.repeat(np.arange(len(open_)), len(flips)), sizes)
                # A code is taken where its nearest segment, the first of those, is looked up, so once only.
                differ = self.codes[at] ^ queries[open_][who]
                near = np.stack([np.bitwise_count((differ >> lo) & ma) for lo, ma, _ in self.segments])
                own = (near.min(axis=0) == radius) & (near.argmin(axis=0) == s)
                at, who = at[own], who[own]
                ends = np.searchsorted(who, np.arange(1, len(open_)))
                for mine, part in zip(found, np.split(at, ends)):
                    mine.append(part)
            tops, reached = self._best(found, queries[open_], k)
            for i, at in zip(open_.tolist(), tops):
                best[i] = at
            open_ = open_[reached > m * (radius + 1) - 1]
        return best


def _block(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    codes = left["code"].to_numpy(np.int64).view(np.uint64)
    asked = right["code"].to_numpy(np.int64)
    rows = []
    if len(codes):
        index = Index(codes, left["ids"].tolist())
        for q, found in zip(asked.tolist(), index.search(asked.view(np.uint64), k)):
            near: dict[int, int] = {}
            ids, owner = index.listed(found)
            far = np.bitwise_count(codes[found] ^ np.int64(q).view(np.uint64))[owner]
            for d, x in sorted(zip(far.tolist(), ids.tolist())):
                near.setdefault(x, d)
            rows += [(q, d, x) for x, d in islice(near.items(), k)]
    return pd.DataFrame(rows, columns=["code", "distance", "id"])


def top_k(codes: DataFrame, queries: Column, k: int = K) -> DataFrame:
    """``id``, ``rank`` (from 1), ``neighbour`` and ``distance`` of the ``k`` rows nearest to each row that
    ``queries`` (a condition on ``id``) picks, among all rows of ``codes`` (``id``, ``code``)."""
    codes = written(codes, "hamming-codes")
    # A rank limit that Spark applies before the shuffle: k + 1 ids of a code a task, however many share it.
    place = F.dense_rank().over(Window.partitionBy("code").orderBy("id"))
    ids = codes.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("code").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    entries = written(ids, "hamming-entries")
    asked = codes.where(queries)
    questions = written(asked.select("code").distinct(), "hamming-questions")
    blocks = max(1, -(-entries.count() // BLOCK_CODES))
    chunks = max(1, -(-questions.count() // CHUNK_QUERIES))

    def dealt(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("code", F.lit(salt)), F.lit(n))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))

    index = entries.select("code", "ids", dealt(blocks, 1).alias("block"), each(chunks).alias("chunk"))
    probes = questions.select("code", dealt(chunks, 2).alias("chunk"), each(blocks).alias("block"))
    found = index.groupBy("block", "chunk").cogroup(probes.groupBy("block", "chunk")).applyInPandas(
        lambda a, b: _block(a, b, k + 1), "code bigint, distance bigint, id bigint"
    )
    nearest = found.groupBy("code", "id").agg(F.min("distance").alias("distance"))
    order = F.row_number().over(Window.partitionBy("code").orderBy("distance", "id"))
    few = nearest.withColumn("place", order).where(F.col("place") <= k + 1)
    pairs = asked.select(F.col("id").alias("asked"), "code").join(few, "code").where("asked <> id")
    others = pairs.groupBy("asked", "id").agg(F.min("distance").alias("distance"))
    rank = F.row_number().over(Window.partitionBy("asked").orderBy("distance", "id"))
    best = others.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select(F.col("asked").alias("id"), "rank", F.col("id").alias("neighbour"), "distance")
