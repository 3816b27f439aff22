"""Every registered query against its SQL on the smallest sample."""

import pytest

import compare
from plumelake.plans import queries

SF = "/root/testdata/sf0.001"
NAMES = list(queries.registered())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    assert compare.differences(spark, name, SF) == []


def test_every_query_of_the_library_has_sql():
    from plumelake.plans import oracle
    assert set(oracle.statements()) == set(queries.registered())
    assert set(compare.contract.oracle_sql()) <= set(compare.contract.queries())


def test_entry(spark):
    df = compare.contract.entry(spark)
    assert df.count() > 0 and "pm25_prom_24h" in df.columns
