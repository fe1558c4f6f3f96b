import pytest

from tests.compare import assert_same
from tidewake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, name):
    assert_same(QUERIES[name](spark, SF), ORACLE[name], SF)
