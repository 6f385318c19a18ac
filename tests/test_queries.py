import pytest

import __spark_entry__ as entry_module
from compare import connect, difference
from scorewright.plans.oracle import ORACLE
from scorewright.plans.queries import QUERIES



@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_entry(spark):
    assert [r.band for r in entry_module.entry(spark).collect()] == ["low", "review", "high"]


#: What fitted models return; tests/test_model_results.py holds it against brute force.
WITHOUT_SQL = {"train_boosting", "permutation_importance_model", "train_and_evaluate", "batch_flow"}


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES) - WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, con, name):
    assert difference(QUERIES[name](spark, sf), con, ORACLE[name]) is None


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())
