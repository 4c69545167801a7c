"""The corpus pipeline: five stages, each over everything the one before it kept.

1. language: documents without a recognisable language go; a missing language is filled in.
2. near_duplicates: of each group of texts linked by 0.8 of their five-word shingles one stays.
3. secrets: secrets, confirmed keys and tokens are replaced by a mark.
4. mix: documents are repeated or thinned until sources meet their targets.
5. bpe: texts become token ids.

Every stage takes and returns a table with the columns of ``documents``, the last one ids instead of
text. A null in any column, repeated rows and an empty table pass through as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcdc.llm import bpe, langid, mixing, ngram_join, secret_scan
from sparkcdc.llm.common import documents, written
from sparkcdc.llm.queries import TOKENIZER

#: Bytes of a batch that goes to a Python worker. Texts differ in length by orders, and most stages hand a text over
#: twice; a batch of Spark's 10,000 rows or 64 MB is held several times over by the JVM and the worker of each task,
#: and the JVM keeps much of what such large buffers took.
BATCH = 4 << 20
#: Pieces and words that a task of the last stage remembers; its workers share the executors with all that ran before.
KNOWN = 1 << 16


def _in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The session keeps the bound: what a stage returns is run later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))
        return stage(spark, docs, sf_dir)

    return run


@_in_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what a language is found for, code-switched or not. Where no row has a usable label there is no
    language to find: every text with a word stays, its language as given."""
    model = langid.train(docs)
    if not model.languages:
        return langid.worded(docs)
    found = langid.identify(docs, model, names=("_found", "_share")).where(F.col("_found") != langid.UNKNOWN)
    return found.select(*[F.coalesce("lang", "_found").alias(c) if c == "lang" else F.col(c) for c in docs.columns])


@_in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group."""
    return ngram_join.one_of_each(docs, width=5, num=80)


@_in_small_batches
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets inside the texts; every document stays."""
    return secret_scan.redact(docs)


@_in_small_batches
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's rate and its own draw say."""
    return mixing.mix(docs)


@_in_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids instead of texts."""
    ids = bpe.encode(docs, TOKENIZER, limit=KNOWN)
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("bpe", encode)]

#: No SQL labels words by a learned model; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
