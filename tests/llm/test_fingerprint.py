import hashlib

import pytest
from pyspark.sql import functions as F

from sparkcdc.llm import fingerprint as fp


def shingles(text):
    words = (text or "").encode().lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(spark, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        out[d] = (t, nxt, t[: len(t) - half] + nxt[:half])
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_true_similarity(spark, folder):
    from sparkcdc.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(spark, rows)
    off = []
    by_text = {}
    got = QUERIES["op5_fingerprints"](spark, folder).collect()
    assert len(got) == len(rows)
    for r in got:
        text, nxt, edited = want[r.doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint and len(r.fingerprint) in (0, 512)
        off += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, nxt)]
    off = [abs(x) for x in off]
    assert sum(off) / len(off) < 0.02 and max(off) < 0.2


def test_rows_of_every_sort(spark):
    long = " ".join(f"w{i % 7919}" for i in range(60_000))
    rows = [(1, None), (2, ""), (700, "one two"), (701, "One  two"), (5000, "é à ü ö ß ñ"), (10**15, long), (-5, "a b c d e f g h"), (None, "x y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("id", F.lit(1)).withColumn("next", F.lit(2))
    got = {r.doc_id: r for r in fp.compared(docs).collect()}
    for d, (text, nxt, edited) in plain(spark, rows).items():
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - jaccard(text, edited)) < 0.2 and abs(r.near_next - jaccard(text, nxt)) < 0.2
    assert got[700].fingerprint == got[701].fingerprint and got[1].fingerprint == "" and got[1].near_next == 1.0
    assert fp.compared(docs.where("false")).count() == 0
    assert fp.compared(docs.where("doc_id = 700")).first()["near_next"] == 1.0
    twice = fp.compared(spark.createDataFrame([(1, "a b c d e f")] * 3, "doc_id bigint, text string")).collect()
    assert len(twice) == 3 and all(r.near_next == 1.0 for r in twice)


def test_densified_values_depend_on_the_set_alone(spark):
    df = spark.createDataFrame([("a b c d e f g",), ("a b c d e f g a b c d e f g",), ("b c d e f g",)], "t string")
    values = [r.v for r in df.select(fp.fingerprint(F.col("t"), width=1).alias("v")).collect()]
    assert values[0] == values[1] and len(values[0]) == fp.BINS and values[0] != values[2]
