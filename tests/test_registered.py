"""Every registered query against its SQL on the same tables."""

import oracle
import pytest

import __spark_entry__ as entry
from docsim.plans.catalogue import QUERIES

# the optional subpackage has its own tests
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql_or_is_tested_otherwise():
    assert not set(NAMES) - set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, con, name):
    difference = oracle.compare(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name])
    assert difference is None, difference


def test_entry(spark):
    assert entry.entry(spark).count() > 0
