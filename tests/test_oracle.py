"""Every query with a SQL twin gives the same columns, types, rows and values."""

import pytest

from oracle_compare import differences, oracle_connection
from shelfcast.oracle import ORACLE_SQL
from shelfcast.plans.queries import PLANS, run


@pytest.fixture(scope="module")
def connection(small):
    return oracle_connection(small)


def test_only_iterative_models_lack_a_twin():
    assert set(PLANS) - set(ORACLE_SQL) == {"residual_gbt", "hybrid_forecast", "hybrid_metrics"}
    assert set(ORACLE_SQL) <= set(PLANS)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_its_twin(spark, small, connection, name):
    assert differences(run(name, spark, small), connection, ORACLE_SQL[name]) == []
