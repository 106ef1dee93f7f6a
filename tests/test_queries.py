"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
import checks
from checks.compare import difference


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, folder, name):
    df = entry.queries()[name](spark, folder)
    assert difference(df, folder, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, folder, name):
    assert entry.queries()[name](spark, folder).count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(checks.ORACLES) <= set(checks.QUERIES)
