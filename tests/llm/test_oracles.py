import pytest
from differential import both

from coldtide.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    got, want = both(spark, QUERIES[name], ORACLES[name])
    assert got == want and len(want[1]) > 0
