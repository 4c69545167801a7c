import pytest
from pyspark.sql import functions as F

from sparkcdc.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, target string"


def test_rows_without_ids_draw_by_their_text(spark):
    rows = [(None, f"w{i} x y", s, "t") for s in "ab" for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = {}
    for r in mixing.copies(docs).collect():
        assert r.copies <= 3
        taken.setdefault(r.row.source, [0, r.target])[0] += r.copies * r["size"]
    assert {s: round(t) for s, (_, t) in taken.items()} == {"a": 800, "b": 1600}
    assert all(n == pytest.approx(t, rel=0.15) for n, t in taken.values())
    again = docs.orderBy(F.desc("text")).repartition(5)
    assert sorted(mixing.mix(again).collect()) == sorted(mixing.mix(docs).collect())


def test_rows_of_every_sort(spark):
    rows = [(1, None, "a", "x"), (2, "", "a", "x"), (3, "w " * 20000, None, None), (3, "w", None, "y"), (None, None, None, None), (4, "u v", "a", "z")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.copies(docs).collect()
    assert len(got) == len(rows)
    assert {(r.row.source, r.source_size) for r in got} == {("a", 2), (None, 20001)}
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.copies(docs.where("false")).count() == 0
    assert mixing.mix(docs.where("text IS NULL")).where("text IS NOT NULL").count() == 0
