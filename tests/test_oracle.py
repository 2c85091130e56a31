"""Every registered query with SQL gives the same rows as DuckDB; the others give rows."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_file

FOLDER = "/root/testdata/sf0.001"
# The long training runs have their own tests on small inputs.
ROWS_ONLY = ("isolation_forest_scores", "anomaly_flags")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry_file.oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    df = entry_file.queries()[name](spark, FOLDER)
    assert difference(df, con, entry_file.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, name):
    assert entry_file.queries()[name](spark, FOLDER).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_entry(spark):
    rows = entry_file.entry(spark).collect()
    assert [r["month"] for r in rows] == list(range(1, 13))
    assert all(r["true_frauds_flagged"] <= r["true_frauds"] for r in rows)
