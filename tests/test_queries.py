import pytest
from differential import both

from coldtide.plans import edge_queries  # noqa: F401
from coldtide.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    got, want = both(spark, QUERIES[name], ORACLES[name])
    assert got[0] == want[0]
    assert len(want[1]) > 0
    assert got[1] == want[1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
