"""Every registered query against the SQL given for it."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import cases
from checks.compare import connect, differences

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(cases.QUERIES) == set(cases.ORACLE)
    assert set(queries()) >= set(cases.QUERIES) and set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(cases.ORACLE))
def test_query_agrees_with_sql(name, spark, sf_dir, con):
    actual = queries()[name](spark, sf_dir).toPandas()
    assert differences(actual, con.execute(SQL[name]).df()) is None


def test_entry(spark):
    assert entry(spark).count() > 0
