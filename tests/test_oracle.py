"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = {n for n in entry.queries() if n not in entry.oracle_sql() and not n.startswith("op") and n != "pipeline"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op")))
def test_query_equals_sql(spark, con, name):
    oracle.compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])


def test_every_query_has_sql():
    assert not ROWS_ONLY


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == entry.queries()["zscore_anomaly"](spark, FOLDER).columns
    assert df.count() == 1000
