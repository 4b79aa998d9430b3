"""Every registered query at the smallest scale: against its SQL where there is one, else that it has rows."""

import pytest
from conftest import SF

import __spark_entry__ as entry
from oracle import connect, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Covered by tests of their own, and slow to repeat here.
SLOW = {"stream_features", "model_kinds", "model_tuning", "permutation_importance", "shapley_summary"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        assert difference(got, duck.execute(SQL[name]).df()) is None
    else:
        assert len(got)


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
