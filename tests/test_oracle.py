"""Every registered query against its DuckDB text on the smallest tables."""

import check
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_sql(spark, con, name):
    ok, note = check.compare(spark, con, FOLDER, name)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
