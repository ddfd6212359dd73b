"""Every registered query equals its DuckDB text on the small sample."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.check import difference, duck
from catalog.queries import ORACLES
from catalog.queries import QUERIES as METRICS

#: The queries on training text have tests of their own.
NAMES = sorted(ORACLES)


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, sf, con, name):
    ours = queries()[name](spark, sf).toPandas()
    assert difference(ours, con.execute(oracle_sql()[name]).df()) is None


def test_entry(spark, sf):
    assert entry(spark).count() > 0


def test_every_metric_has_an_oracle():
    assert set(METRICS) == set(ORACLES)
    assert set(METRICS) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
