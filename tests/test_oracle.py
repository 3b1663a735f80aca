"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from gaugeline.plans.catalogue import QUERIES as OWN
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_registry():
    assert set(ORACLE) <= set(QUERIES)
    assert set(OWN) <= set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "indicator_code", "indicator_name", "country_code", "year", "value", "category", "source_system"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLE[name], SF) is None
