"""Every named query against its SQL on the small tables."""

import pytest
from compare import connect, difference
from conftest import SMALL

from cardwatch.plans import ORACLES, QUERIES

SLOW = {"ml_evaluate", "ml_best", "ml_predict", "ml_importance", "ml_cross_validate", "ml_reload", "ml_stream"}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_rows_agree(spark, con, name):
    assert difference(con, ORACLES[name], QUERIES[name](spark, SMALL)) is None


def test_only_models_and_generator_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"gen_transactions", "ml_evaluate", "ml_best", "ml_predict", "ml_importance",
                                           "ml_cross_validate"}


def test_entry(spark):
    import __spark_entry__ as contract
    rows = contract.entry(spark).collect()
    assert sum(r["transaction_count"] for r in rows) == 1000
    assert set(contract.oracle_sql()) <= set(contract.queries())
