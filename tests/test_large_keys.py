"""Registered queries on tables whose keys pass what the small tables hold."""

import check
import pytest

from sparkcdc.operators import retry


@pytest.fixture(scope="module")
def late_events(spark, tmp_path_factory):
    """Events numbered on both sides of the first million."""
    folder = tmp_path_factory.mktemp("late-events")
    ids = spark.range(999_000, 1_001_000)
    rows = ids.selectExpr(
        "id AS event_id", "timestamp_micros(1704067200000000L + id * 1000000L) AS ts", "id % 50 AS user_id", "'view' AS event_type",
        "1.0D AS value", "'{\"k\": 1}' AS props",
    )
    rows.coalesce(1).write.parquet(str(folder / "events.parquet"))
    return folder


def test_dead_letter_query_is_its_sql_past_a_million_events(spark, late_events):
    con = check.duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{late_events}/events.parquet/*.parquet'")
    ok, note = check.compare(spark, con, str(late_events), "dead_letter")
    assert ok, note


def test_dead_letter_operator_keeps_letters_of_any_number(spark):
    columns = "dl_id bigint, queue string, consumer string, ev_id bigint, ev_type string, reason string"
    old = spark.createDataFrame([(1, "q", "c", 1, "t", "kept")], columns)
    new = spark.createDataFrame([(3_000_000_000, "q", "c", n, "t", "new") for n in (1, 2)], columns)
    assert sorted(r["ev_id"] for r in retry.dead_letter(old, new).collect()) == [1, 2]


def test_dead_letter_query_takes_in_letters_of_any_number(spark, tmp_path):
    """Each letter once, on both sides of the first and second million; second copies lose to first ones, not to a bound."""
    numbers = range(970_000, 2_100_000, 97)
    spark.range(numbers.start, numbers.stop, numbers.step).selectExpr(
        "id AS event_id", "timestamp_micros(1704067200000000L + id * 1000000L) AS ts", "id % 50 AS user_id", "'view' AS event_type",
        "1.0D AS value", "'{\"k\": 1}' AS props",
    ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    want = sorted(
        (n + 1, n, "kept", f"q{n % 50 % 3}", f"c{n % 50}") if n % 2 == 0 else (n + 1, n + 1_000_000, "new", f"q{n % 50 % 3}", f"c{n % 50}")
        for n in numbers
        if n % 7 >= 5
    )
    columns = ["ev_id", "dl_id", "reason", "queue", "consumer"]
    rows = check.entry.queries()["dead_letter"](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(tuple(r) for r in rows) == want
    con = check.duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    rows = con.sql(check.entry.oracle_sql()["dead_letter"]).select(*columns).fetchall()
    assert sorted(rows) == want
