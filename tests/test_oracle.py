"""Every registered query against its SQL equivalent."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import assert_same, connect

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert assert_same(queries()[name](spark, SF), con, oracle_sql()[name]) > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry_has_a_stable_schema(spark):
    assert entry(spark).schema == entry(spark).schema
    assert entry(spark).count() > 0
