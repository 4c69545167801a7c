import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_ngram_join import brute

import corpus_pipeline
from sparkcdc.llm import mixing, secret_scan
from sparkcdc.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    first = corpus_pipeline.language(spark, docs, FOLDER)
    assert first.columns == columns and {r.doc_id for r in first.collect()} == set(rows)
    second = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    kept = sorted(r.doc_id for r in second.collect())
    want = brute([(k, r.text) for k, r in rows.items()], 5, 80, 100)
    assert second.columns == columns and kept == sorted(d for d, _, c in want if d == c)
    third = corpus_pipeline.secrets(spark, docs, FOLDER)
    assert third.columns == columns
    for r in third.collect():
        plain = secret_scan.redacted(rows[r.doc_id].text, frozenset(secret_scan.KINDS), "[secret]")
        assert (r.text, r.n_chars) == (plain, len(plain)) and not secret_scan.spans(r.text.replace("[secret]", " "))
    fourth = corpus_pipeline.mix(spark, docs, FOLDER)
    times = {r.doc_id: r.n for r in fourth.groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    taken = mixing.copies(docs).select("row.doc_id", "copies").collect()
    assert fourth.columns == columns and times == {r.doc_id: r.copies for r in taken if r.copies}


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    rows = got.collect()
    ids = set(pq.read_table(f"{FOLDER}/documents.parquet")["doc_id"].to_pylist())
    assert rows and {r.doc_id for r in rows} <= ids and all(len(r.ids) == r.n_tokens for r in rows)
    again = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in rows) == sorted((r.doc_id, tuple(r.ids)) for r in again)


def test_rows_of_every_sort(spark):
    text = "the cat sat on the mat and saw a dog there today"
    rows = [(i, text if i < 8 else f"der hund {i} und die katze {i} gehen in das haus", "en" if i < 8 else "de", "s", 1) for i in range(12)]
    rows += [(None, None, None, None, None), (20, "", None, "s", 0), (21, "1 2 3", "en", None, 5), (3, text, "en", "s", 1), (9, rows[9][1], "de", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for stage in (docs, docs.where("false")):
        for _, fn in corpus_pipeline.STAGES[:-1]:
            stage = fn(spark, stage, "")
            assert stage.columns == docs.columns
            stage.collect()
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept if r.text and r.lang) == [0, 8, 9, 10, 11, 21]


def test_without_usable_labels_documents_stay(spark):
    rows = [(1, "the cat sat", None), (None, "der hund", "de"), (2, None, None), (3, "1 2 3", None), (4, "", None), (1, "the cat sat", None)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = corpus_pipeline.language(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.lang) for r in got.collect()), key=str) == sorted([rows[0], rows[0], rows[1]], key=str)


def test_mix_meets_targets(spark):
    rows = QUERIES["op9_mix_sources"](spark, "/root/testdata/sf0.1").collect()
    by_source = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        entry = by_source.setdefault((r.source_size, r.target), [0])
        entry[0] += r.taken
    assert abs(sum(t for _, t in by_source) - sum(r.size for r in rows)) < 1e-3 * sum(r.size for r in rows)
    assert all(abs(n - t) < 0.15 * t and t <= 3 * s for (s, t), (n,) in by_source.items())


def test_mix_rows_of_every_sort(spark):
    rows = [(1, "a b c", "x", 1), (2, "d", None, 1), (None, None, "y", 1), (3, "", "y", 1), (1, "a b c", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int").withColumnRenamed("size", "rate")
    got = mixing.copies(docs).collect()
    assert len(got) == 5 and sum(r.size for r in got) == 7 and {r.row.source: r.target for r in got} == {"x": 3.5, "y": 0.0, None: 3.0} | {"x": 4.0}
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs.where("false")).count() == 0


def test_batches_are_bounded_by_bytes(spark):
    docs = spark.range(64).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("word "), "id"), 60_000).alias("text"),
                                  F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("bigint").alias("n_chars"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["size", "rows"])

    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs.limit(0), "")
        seen = docs.coalesce(1).mapInArrow(sizes, "size bigint, rows bigint").collect()
        # The row that reaches the bound is the last of its batch.
        assert sum(r.rows for r in seen) == 64 and max(r.size for r in seen) < 5_000_000
