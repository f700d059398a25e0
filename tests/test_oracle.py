"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from aislewise.plans.oracle import ORACLE_SQL as SQL
from aislewise.plans.queries import QUERIES
from oracle_check import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert difference(spark, con, QUERIES[name], SQL[name], sf_dir) is None


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
