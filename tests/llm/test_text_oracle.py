"""Text queries with SQL, on the smallest tables; the larger ones are compared with all others."""

import pytest

from dockflow.llm.queries import LLM_ORACLE, LLM_QUERIES
from tests.compare import assert_same, connect


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_matches_sql(spark, small, name):
    assert assert_same(LLM_QUERIES[name](spark, small), connect(small), LLM_ORACLE[name]) == 200
