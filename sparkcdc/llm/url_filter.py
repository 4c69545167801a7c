"""URL filters by a weighted vocabulary.

One Aho-Corasick automaton finds all terms of a lower-cased URL in a single pass. A hit counts only between
boundaries, where no letter or digit adjoins. One strict term rejects; soft terms reject when there are several
distinct ones and their weights reach a threshold. Rules for hosts and paths go before the vocabulary.

Nulls and ties: a null URL, or one without ``://``, has an empty host and path, fits no rule and, where
there is text, is still judged by its terms. Of the rules that fit the one with the longest text wins, then
the one that is first in order. Rows are judged on their own; a URL of any length is read once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcdc.llm.common import lower_ascii

#: The vocabulary. Strict terms reject alone, soft ones carry a weight.
STRICT = ("adult", "casino", "escort", "hentai", "porn", "sexcam", "spam", "warez", "xxx")
SOFT = {"ads": 1, "bet": 1, "bets": 1, "bonus": 1, "cheap": 1, "click": 1, "dating": 1, "deal": 1, "farm": 1, "free": 1, "jackpot": 2,
        "loan": 1, "pills": 1, "poker": 2, "replica": 1, "sex": 2, "track": 1, "viagra": 2, "win": 1}
THRESHOLD = 2
#: Distinct soft terms that are needed beside the weight.
SEVERAL = 2
#: Terms that a vocabulary read from a table may have: every task holds all of them.
MAX_TERMS = 1 << 20
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Fixed values: (verdict, host, start of the path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Vocabulary:
    strict: Sequence[str] = STRICT
    soft: dict[str, int] = field(default_factory=lambda: dict(SOFT))
    threshold: int = THRESHOLD
    several: int = SEVERAL

    @classmethod
    def read(cls, table: DataFrame, *, term: str = "term", weight: str = "weight", threshold: int = THRESHOLD,
             several: int = SEVERAL, limit: int = MAX_TERMS) -> Vocabulary:
        """The vocabulary in a table of terms and weights; without a weight a term is strict.

        Terms are lower-cased; null and empty ones are left out. Of a repeated term the strict row goes first,
        then the heaviest. A table of more than ``limit`` terms is refused, since every task holds all of them.
        """
        shown, given = lower_ascii(F.col(term)), F.col(weight).cast("bigint")
        terms = table.where(F.length(term) > 0).groupBy(shown.alias("term")).agg(
            F.max(given.isNull()).alias("strict"), F.max(given).alias("weight")
        )
        rows = terms.limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"more than {limit} terms")
        return cls(sorted(r.term for r in rows if r.strict), {r.term: r.weight for r in rows if not r.strict}, threshold, several)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term in self.soft:
            found.add_word(term, (term, False))
        for term in self.strict:
            found.add_word(term, (term, True))
        found.make_automaton()
        return found


def _bounded(text: str, start: int, end: int) -> bool:
    before, after = text[start - 1 : start], text[end : end + 1]
    return not (before.isascii() and before.isalnum()) and not (after.isascii() and after.isalnum())


def term_hits(url: str | None, automaton: ahocorasick.Automaton, soft: dict[str, int]) -> tuple[list[str], list[str], int]:
    """(strict terms, soft terms, weight of the soft ones), each distinct and in order."""
    strict_hits, soft_hits = set(), set()
    text = (url or "").translate(_LOWER)
    if text and len(automaton):
        for last, (term, strict) in automaton.iter(text):
            if _bounded(text, last + 1 - len(term), last + 1):
                (strict_hits if strict else soft_hits).add(term)
    return sorted(strict_hits), sorted(soft_hits), sum(soft[t] for t in soft_hits)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The winning rule as a struct (text, verdict), null where none fits."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [
        F.when(
            ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(start)),
            F.struct(F.lit(rule_host + start).alias("text"), F.lit(verdict).alias("verdict")),
        )
        for verdict, rule_host, start in ordered
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<text:string,verdict:string>")


def judged(pages: DataFrame, *, key: str = "page_id", url: str = "url", vocabulary: Vocabulary | None = None,
           rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per row ``key``, ``host``, ``path``, ``rule``, ``verdict``, the terms found and their weight. No shuffle."""
    words = vocabulary or Vocabulary()
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = words.automaton()
        for batch in batches:
            found = [term_hits(u, automaton, words.soft) for u in batch.column(1).to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.list_(pa.string()), pa.list_(pa.string()), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], schema.names)

    terms = T.ArrayType(T.StringType())
    schema = T.StructType([*rows.schema.fields, T.StructField("strict", terms), T.StructField("soft", terms), T.StructField("weight", T.LongType())])
    hits = rows.mapInArrow(run, schema).select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = hits.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    softly = (F.size("soft") >= words.several) & (F.col("weight") >= words.threshold)
    own = F.when((F.size("strict") > 0) | softly, "block").otherwise("allow")
    return ruled.select(
        F.col("key").alias(key), "host", "path", F.col("fit.text").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"),
        "strict", "soft", "weight",
    )
