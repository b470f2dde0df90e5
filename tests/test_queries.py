import pytest
from oracle import assert_equal

from sievework.plans import registry

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    if name in registry.ORACLES:
        assert_equal(spark, SMALL, registry.QUERIES[name], registry.ORACLES[name])
    else:
        assert registry.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
