"""Every registered query at the smallest scale, against its SQL oracle where there is one."""

import pytest

from stratawell.registry import all_queries
from tools.check_oracles import compare, connect

QUERIES = {name: q.build for name, q in all_queries().items()}
ORACLES = {name: q.sql for name, q in all_queries().items() if q.sql}
FITTED = {"gbt_fit", "rf_fit", "feature_importance", "iforest_scores", "batch_scoring"}


@pytest.fixture(scope="module")
def duck(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, tiny, duck, name):
    verdict = compare(QUERIES[name](spark, tiny), duck.sql(ORACLES[name]))
    assert verdict.startswith("ok"), verdict


def test_only_fitted_models_have_no_oracle():
    assert set(QUERIES) - set(ORACLES) == FITTED


@pytest.mark.parametrize("name", sorted(FITTED))
def test_fitted(spark, tiny, name):
    assert QUERIES[name](spark, tiny).count() > 0
