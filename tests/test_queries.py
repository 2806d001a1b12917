import pytest

import __spark_entry__ as entry
from tools.check import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    ok, note = compare(spark, con, name, sf_dir)
    assert ok, note
