"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import itertools
import uuid
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcdc.session import ensure_checkpoint_dir

#: Fixed value: what separates words, everywhere in this subpackage.
WORD = r"[^\x20\x09-\x0D]+"

_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared checkpoint folder: lineage ends there, and a lost
    executor costs a reread of a file instead of a recomputation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    # Nothing reads this write's shuffle files again: they need not wait for the driver's garbage collector.
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def sha256(value: Column) -> Column:
    """Lowercase hex digest of a text's UTF-8 bytes."""
    return F.sha2(value, 256)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbering() -> defaultdict:
    """A dictionary that numbers keys as they are first asked for, from 0. It is in no cycle with what gives the
    numbers, so it goes as soon as it is let go."""
    return defaultdict(itertools.count().__next__)


def numbered(numbers: defaultdict, keys: Iterable) -> np.ndarray:
    """The number of each key; new keys get the next ones."""
    return np.fromiter(map(numbers.__getitem__, keys), np.int64)


class Ragged:
    """Lists of numbers side by side in one array, added and read many at a time."""

    def __init__(self, kind: type = np.int32):
        self.flat = np.zeros(1 << 12, kind)
        self.starts = np.zeros(1 << 10, np.int64)
        self.lengths = np.zeros(1 << 10, np.int64)
        self.used = self.count = 0

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat = _room(self.flat, self.used + len(flat))
        self.starts = _room(self.starts, self.count + len(lengths))
        self.lengths = _room(self.lengths, self.count + len(lengths))
        self.flat[self.used : self.used + len(flat)] = flat
        new = slice(self.count, self.count + len(lengths))
        self.lengths[new] = lengths
        self.starts[new] = self.used + np.cumsum(lengths) - lengths
        self.used += len(flat)
        self.count += len(lengths)

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at these places, joined, and their lengths."""
        lengths = self.lengths[at]
        shift = self.starts[at] - (np.cumsum(lengths) - lengths)
        return self.flat[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)], lengths


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.zeros(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of ``values``; a stretch may be empty."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return upto[ends] - upto[ends - lengths]
