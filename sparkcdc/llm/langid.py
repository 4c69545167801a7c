"""Language identification by a linear-chain conditional random field.

Every word of a sentence is labelled with a language. Emissions are sums of learned weights of the
word's affixes and inner n-grams (runs of 2 to 4 characters, with marks at both ends) and of the word
itself; learned transitions say how likely the language changes from word to word. Forward-backward
gives each word's distribution, and a document's language is the one with the largest share of its
words. Code-switched text is therefore labelled word by word.

Training chains are spans of sampled documents set one after the other, so that changes of language are
seen. The sample is bounded per language (``per_language`` documents, by a hash of the id).

Nulls and ties: a null text, or one without a letter, is ``und`` with score 0, and so is everything if
nothing is labelled. Equal shares go to the language that is first by name. A null id hashes as an empty
text. Rows are labelled on their own, so repeated rows agree; a sentence may be of any length.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcdc.llm.common import written

from sparkcdc.llm.ngram_join import mixed

UNKNOWN = "und"
PER_LANGUAGE = 300
FEATURE_BITS = 17
GRAMS = (2, 3, 4)
KNOWN_WORDS = 1 << 18
_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_CHAIN = 32
_SHARES = 1 << 31
_SALT = np.uint64(0x9E3779B97F4A7C15)


def sentences(text: str) -> list[list[str]]:
    found = [_WORD.findall(part) for part in _SENTENCE.split(text.lower())]
    # The pattern also takes a few number signs; a word has a letter.
    return [kept for words in found if (kept := [w for w in words if w.isalpha() or any(map(str.isalpha, w))])]


def features(words: Sequence[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, index of its word): hashed n-grams of the marked word, and the whole word."""
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    chars = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths) - lengths
    shift = np.uint64(64 - bits)
    out, owner = [], []
    for n in GRAMS:
        inside = np.flatnonzero(word[: len(word) - n + 1] == word[n - 1 :]) if len(word) >= n else np.empty(0, np.int64)
        h = np.full(len(inside), n, np.uint64)
        for k in range(n):
            h = mixed(h * _SALT + chars[inside + k])
        out.append(h >> shift)
        owner.append(word[inside])
    if len(words):
        place = (np.arange(len(word)) - starts[word]).astype(np.uint64)
        whole = np.add.reduceat(mixed(chars + (place << np.uint64(32)) + _SALT), starts)
        out.append(mixed(whole) >> shift)
        owner.append(np.arange(len(words)))
    return np.concatenate(out).astype(np.int64), np.concatenate(owner)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # feature x language
    moves: np.ndarray  # language x language
    start: np.ndarray

    @property
    def bits(self) -> int:
        return int(self.weights.shape[0]).bit_length() - 1

    def emissions(self, words: Sequence[str]) -> np.ndarray:
        feature, owner = features(words, self.bits)
        out = np.empty((len(words), len(self.languages)))
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(owner, self.weights[feature, k], minlength=len(words))
        return out

    def dump(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, languages=np.array(self.languages), weights=self.weights, moves=self.moves, start=self.start)
        return file.getvalue()

    @staticmethod
    def load(data: bytes) -> Model:
        parts = np.load(io.BytesIO(data))
        return Model([str(x) for x in parts["languages"]], parts["weights"], parts["moves"], parts["start"])


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray):
    """Marginals of every word, and the expected counts of transitions and starts.

    ``scores`` holds the chains one after the other. Chains are stepped through together, longest first,
    so that those still running are always the first ones.
    """
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    running = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
    heat = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(moves)
    alpha, beta = np.empty_like(heat), np.ones_like(heat)
    for t, m in enumerate(running):
        at = begin[:m] + t
        now = heat[at] * (np.exp(start) if t == 0 else alpha[at - 1] @ step)
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    pairs = np.zeros_like(step)
    for t in range(len(running) - 1, 0, -1):
        at = begin[: running[t]] + t
        ahead = heat[at] * beta[at]
        back = ahead @ step.T
        norm = (alpha[at - 1] * back).sum(axis=1, keepdims=True)
        pairs += (alpha[at - 1] / norm).T @ ahead * step
        beta[at - 1] = back / back.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    return gamma, pairs, gamma[begin].sum(axis=0)


def fit(texts: Sequence[str], labels: Sequence[str], bits: int = FEATURE_BITS, epochs: int = 3, rate: float = 0.3, seed: int = 11) -> Model:
    """Maximum likelihood by adaptive gradient steps over chains that mix spans of the documents."""
    names = sorted(set(labels))
    code = {name: i for i, name in enumerate(names)}
    rng = np.random.default_rng(seed)
    index: dict[str, int] = {}
    spans = []
    for text, label in zip(texts, labels):
        words = [index.setdefault(w, len(index)) for s in sentences(text) for w in s]
        at = 0
        while at < len(words):
            size = int(rng.integers(3, _CHAIN))
            spans.append((np.array(words[at : at + size]), code[label]))
            at += size
    k = len(names)
    model = Model(names, np.zeros((1 << bits, k)), np.zeros((k, k)), np.zeros(k))
    if not spans:
        return model
    feature, owner = features(list(index), bits)
    order = np.argsort(owner, kind="stable")
    feature = feature[order]
    firsts = np.searchsorted(owner[order], np.arange(len(index) + 1), side="left")
    seen = [np.full_like(model.weights, 1e-3), np.full_like(model.moves, 1e-3), np.full_like(model.start, 1e-3)]
    for _ in range(epochs):
        shuffled = rng.permutation(len(spans))
        for low in range(0, len(shuffled), 1024):
            part = [spans[i] for i in shuffled[low : low + 1024]]
            words = np.concatenate([w for w, _ in part])
            truth = np.repeat([c for _, c in part], [len(w) for w, _ in part])
            # Two or three spans make a chain: neighbours in random order mostly differ in language.
            sizes = [len(w) for w, _ in part]
            lengths = np.array([sum(sizes[i : i + 3]) for i in range(0, len(sizes), 3)])
            begin = np.cumsum(lengths) - lengths
            distinct, place = np.unique(words, return_inverse=True)
            counts = firsts[distinct + 1] - firsts[distinct]
            flat = np.repeat(firsts[distinct] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            used, user = feature[flat], np.repeat(np.arange(len(distinct)), counts)
            scores = np.stack([np.bincount(user, model.weights[used, c], minlength=len(distinct)) for c in range(k)], axis=1)[place]
            gamma, pairs, starts = forward_backward(scores, lengths, model.moves, model.start)
            error = -gamma
            error[np.arange(len(words)), truth] += 1
            inner = np.ones(len(words), bool)
            inner[begin] = False
            at = np.flatnonzero(inner)
            told = np.zeros((k, k))
            np.add.at(told, (truth[at - 1], truth[at]), 1)
            n = len(words)
            grads = [None, (told - pairs) / n - 1e-4 * model.moves, (np.bincount(truth[begin], minlength=k) - starts) / n - 1e-4 * model.start]
            by_word = np.stack([np.bincount(place, error[:, c], minlength=len(distinct)) for c in range(k)], axis=1)
            grads[0] = np.stack([np.bincount(used, by_word[user, c], minlength=1 << bits) for c in range(k)], axis=1) / n - 1e-6 * model.weights
            for value, grad, past in zip((model.weights, model.moves, model.start), grads, seen):
                past += grad * grad
                value += rate * grad / np.sqrt(past)
    return Model(names, model.weights.astype(np.float32), model.moves, model.start)


class Labeller:
    """Labels documents with a model; remembers the emissions of words it has met."""

    def __init__(self, model: Model, limit: int = KNOWN_WORDS):
        self.model, self.limit = model, limit
        self.index: dict[str, int] = {}
        self.table = np.empty((0, len(model.languages)))

    def marginals(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(distribution of every word of all texts, index of its text)."""
        if len(self.index) > self.limit:
            self.index, self.table = {}, self.table[:0]
        index, found, owners, lengths = self.index, [], [], []
        before = len(index)
        for i, text in enumerate(texts):
            for words in sentences(text) if text else ():
                found += [index.setdefault(w, len(index)) for w in words]
                owners.append(i)
                lengths.append(len(words))
        if len(index) > before:
            new = list(index)[before:] if before else list(index)
            self.table = np.concatenate([self.table, self.model.emissions(new)])
        if not found:
            return self.table[:0], np.empty(0, np.int64)
        sizes = np.array(lengths)
        gamma, _, _ = forward_backward(self.table[found], sizes, self.model.moves, self.model.start)
        return gamma, np.repeat(owners, sizes)

    def label(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        if not self.model.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        gamma, owner = self.marginals(texts)
        total = np.stack([np.bincount(owner, gamma[:, c], minlength=len(texts)) for c in range(gamma.shape[1])], axis=1)
        words = np.bincount(owner, minlength=len(texts))
        best = total.argmax(axis=1)
        share = total[np.arange(len(texts)), best] / np.maximum(words, 1)
        names = [self.model.languages[b] if w else UNKNOWN for b, w in zip(best.tolist(), words.tolist())]
        return names, [min(max(float(s), 0.0), 1.0) if w else 0.0 for s, w in zip(share, words.tolist())]

    def runs(self, text: str | None) -> list[tuple[int, int, str]]:
        """(first word, word after the last, language) of the stretches of a code-switched text."""
        gamma, _ = self.marginals([text])
        best = gamma.argmax(axis=1)
        cuts = np.flatnonzero(np.diff(best)) + 1
        bounds = [0, *cuts.tolist(), len(best)] if len(best) else [0]
        return [(a, b, self.model.languages[int(best[a])]) for a, b in zip(bounds, bounds[1:])]


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows where it is 1 are held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model from at most ``per_language`` labelled documents a language, those whose id and text have the least
    hash. Rows that repeat both count once. No language with a usable row is left out.

    The driver sees their ids and the finished model; one task reads the bounded sample and fits.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("id").isNotNull() & (remainder(F.col("id")) != 1))
    # Only hashes below a share that leaves some four times the bound are ranked, so a frequent language is
    # no more work for its task than a rare one. The share follows how many different documents a language has: many
    # rows on few ids or texts leave it whole. The counts are a table of their own, so they meet the rows before these move.
    digest = F.sha2("text", 256).alias("digest")
    own = F.xxhash64("id", "text")
    counts = written(usable.groupBy("lang").agg(F.approx_count_distinct(own, 0.02).alias("documents")), "langid-counts")
    hashed = usable.withColumn("share", F.pmod(own, F.lit(_SHARES))).join(counts, "lang")
    few = hashed.where(F.col("share").cast("double") * F.col("documents") < 4 * per_language * _SHARES).select("id", "lang", "share", digest)
    named = few.select("id", "lang", "share", "digest").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("share", "id", "digest"))
    chosen = named.withColumn("place", place).where(F.col("place") <= per_language).select("id", "lang", "digest")
    picks = chosen.collect()
    if not picks:
        return Model([], np.zeros((1, 0)), np.zeros((0, 0)), np.zeros(0))
    near = usable.where(F.col("id").isin(sorted({r["id"] for r in picks}))).select("*", digest)
    listed = docs.sparkSession.createDataFrame(picks, chosen.schema)
    # What repeats an id, a label and a text is read once, so the sample is the picks, however rows lie.
    sample = near.join(listed, ["id", "lang", "digest"], "left_semi").dropDuplicates(["id", "lang", "digest"]).select("id", "text", "lang").coalesce(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += batch.column(1).to_pylist()
            labels += batch.column(2).to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
        data = fit([texts[i] for i in order], [labels[i] for i in order]).dump()
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["model"])

    return Model.load(bytes(sample.mapInArrow(run, "model binary").first()["model"]))


def identify(docs: DataFrame, model: Model, *, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds the predicted language and its share of the words, replacing columns of those names. Only the
    text is read for a prediction; no shuffle, and a task holds a slice of a batch."""
    kept = [c for c in docs.columns if c not in names]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    data = model.dump()
    schema = T.StructType([rows.schema["row"], T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(Model.load(data))
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found, scores = labeller.label(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return rows.mapInArrow(run, schema).select("row.*", F.col("lang").alias(names[0]), F.col("score").alias(names[1]))


def worded(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows whose text has a word to label, whatever its language."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = [any(sentences(t)) if t else False for t in batch.column(1).to_pylist()]
            yield batch.select(["row"]).filter(pa.array(has, pa.bool_()))

    return rows.mapInArrow(run, T.StructType([rows.schema["row"]])).select("row.*")
