"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from gridloom.plans import catalog
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    difference, _ = compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF)
    assert difference is None, difference


def test_entry(spark):
    df = contract.entry(spark)
    assert "total_kwh" in df.columns and not df.isEmpty()
