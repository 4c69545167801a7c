"""Packing token sequences into rows of one length: best fit decreasing.

Sequences longer than a row are split into row-long pieces and a rest, nothing is dropped. Within a block of
documents the pieces go, longest first, each into the fullest row that still has room for it; a segment tree
over the possible capacities, holding how many rows have each, finds it in log2(length) steps. Every row
carries its ids, the cumulative segment lengths and the positions, which start again with each segment.

Blocks are packed where they are read, so ids are never shuffled; a block is bounded by ``block`` tokens
(or one document), and a task holds one block. Blocks follow the partitions of the input: other partitions
give other rows, of the same documents.

Nulls and ties: null or empty ids make no segment, so such a document is in no row. Pieces of one length keep
the order of their documents; of rows with the same room the one opened first is filled. Rows may repeat ids
of documents. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENGTH = 2048
BLOCK_TOKENS = 1 << 21
PAD = 0


class Capacities:
    """Rows by the room they have left: a segment tree of counts over 0..length, and the rows of each leaf."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.counts = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]
        self.heads = [0] * (length + 1)

    def _add(self, room: int, change: int) -> None:
        at, counts = room + self.size, self.counts
        while at:
            counts[at] += change
            at >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(row, room) of the row with the least room of at least ``least``; it is taken out."""
        counts, at = self.counts, least + self.size
        if not counts[at]:
            # Up to the first right neighbour that holds a row, then down its left side.
            while at > 1 and (at & 1 or not counts[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if counts[2 * at] else 2 * at + 1
        room = at - self.size
        row = self.rows[room][self.heads[room]]
        self.heads[room] += 1
        self._add(room, -1)
        return row, room


def best_fit_decreasing(lengths: Sequence[int], length: int) -> list[int]:
    """The row of each piece; pieces are 1 to ``length`` long."""
    order = np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist()
    capacities, rows, count = Capacities(length), [0] * len(order), 0
    for i in order:
        found = capacities.take(lengths[i])
        if found is None:
            found = (count, length)
            count += 1
        row, room = found
        rows[i] = row
        capacities.put(room - lengths[i], row)
    return rows


def _packed_block(ids: list[np.ndarray], docs: list, length: int, pad: int) -> dict[str, list]:
    pieces = [(d, at, min(length, len(x) - at)) for d, x in enumerate(ids) for at in range(0, len(x), length)]
    rows = best_fit_decreasing([p[2] for p in pieces], length)
    by_row: list[list[int]] = [[] for _ in range(max(rows, default=-1) + 1)]
    for i, row in enumerate(rows):
        by_row[row].append(i)
    out: dict[str, list] = {"ids": [], "cu_seqlens": [], "position_ids": [], "segments": []}
    for members in by_row:
        matrix, positions, ends, segments = np.full(length, pad, np.uint32), np.zeros(length, np.uint32), [0], []
        for i in members:
            d, at, size = pieces[i]
            start = ends[-1]
            matrix[start : start + size] = ids[d][at : at + size]
            positions[start : start + size] = np.arange(size)
            ends.append(start + size)
            segments.append({"doc": docs[d], "at": at, "length": size})
        out["ids"].append(matrix.astype("<u4").tobytes())
        out["position_ids"].append(positions.astype("<u4").tobytes())
        out["cu_seqlens"].append(ends)
        out["segments"].append(segments)
    return out


def _schema(doc: T.StructField) -> T.StructType:
    segment = T.StructType([T.StructField("doc", doc.dataType), T.StructField("at", T.LongType()), T.StructField("length", T.LongType())])
    return T.StructType(
        [T.StructField("ids", T.BinaryType()), T.StructField("position_ids", T.BinaryType()),
         T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())), T.StructField("segments", T.ArrayType(segment))]
    )


def _packed(rows: DataFrame, sequences, length: int, block: int, pad: int) -> DataFrame:
    """Packs what ``sequences()`` makes of each batch's second column, in blocks of ``block`` tokens."""
    schema = _schema(rows.schema[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sequences()
        held: list[np.ndarray] = []
        docs: list = []
        size, kind = 0, None

        def done() -> pa.RecordBatch:
            found = _packed_block(held, docs, length, pad)
            part = pa.list_(pa.struct([("doc", kind), ("at", pa.int64()), ("length", pa.int64())]))
            types = {"ids": pa.binary(), "position_ids": pa.binary(), "cu_seqlens": pa.list_(pa.int32()), "segments": part}
            return pa.RecordBatch.from_arrays([pa.array(found[c], types[c]) for c in schema.names], schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, found in zip(batch.column(0).to_pylist(), of(batch.column(1))):
                if not len(found):
                    continue
                held.append(found)
                docs.append(doc)
                size += len(found)
                if size >= block:
                    yield done()
                    held, docs, size = [], [], 0
        if held:
            yield done()

    return rows.mapInArrow(run, schema)


def pack(df: DataFrame, *, doc_id: str = "doc_id", ids: str = "ids", length: int = LENGTH, block: int = BLOCK_TOKENS, pad: int = PAD) -> DataFrame:
    """One row per packed row: ``ids`` and ``position_ids`` (``length`` little-endian 32-bit integers each),
    ``cu_seqlens`` (0 and the end of every segment) and ``segments`` (doc, at: first token in the document,
    length), in the order in which they stand in the row."""

    def sequences():
        def of(lists: pa.Array) -> Iterator[np.ndarray]:
            flat, ends, there = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().tolist(), lists.is_valid().to_pylist()
            return (flat[a:b].copy() if ok else flat[:0] for a, b, ok in zip(ends, ends[1:], there))

        return of

    return _packed(df.select(F.col(doc_id).alias("doc"), F.col(ids).alias("ids")), sequences, length, block, pad)


def rank_encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a file of ranks, a token in base64 and its rank a line."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pack_texts(df: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
               block: int = BLOCK_TOKENS, pad: int = PAD) -> DataFrame:
    """Like :func:`pack`, with the ids of the texts by a rank file at ``path``, which must be on every
    executor. Ids never leave the task that packs them. A null text has none."""

    def sequences():
        encoding = rank_encoding(path, pattern)
        return lambda texts: (np.array(encoding.encode_ordinary(t.as_py() or ""), np.uint32) for t in texts)

    return _packed(df.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")), sequences, length, block, pad)


def write_packed(packed: DataFrame, path: str) -> None:
    """Packed rows as Parquet: binary id matrices row by row, lengths and positions beside them."""
    packed.write.mode("overwrite").parquet(path)
