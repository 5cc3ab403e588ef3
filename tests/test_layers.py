from strata.plans.layers import first_load, first_load_by_merge
from strata.schemas import FIXTURE_ENTITIES
from strata.sources import fixtures

from .conftest import SF_SMALL


def test_first_load_is_merge_into_empty(spark):
    for name, fn in fixtures.ADAPTERS.items():
        batch = fn(spark, SF_SMALL)
        e = FIXTURE_ENTITIES[name]
        a = sorted(map(tuple, first_load(spark, batch, e).collect()), key=str)
        b = sorted(map(tuple, first_load_by_merge(spark, batch, e).collect()), key=str)
        assert a == b and len(a) > 0


def test_merge_into_empty_is_folded(spark):
    e = FIXTURE_ENTITIES["orders"]
    df = first_load_by_merge(spark, fixtures.orders(spark, SF_SMALL), e)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
