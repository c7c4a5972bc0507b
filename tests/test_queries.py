"""Every registered query against its SQL on whole tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

from coursegrain.bindings import REGISTRY

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_agrees_with_sql(spark, con, name):
    query = REGISTRY[name]
    assert differences(query(spark, SMALL), con, query.sql) == []


def test_every_query_has_sql():
    assert [n for n, q in REGISTRY.items() if not q.sql] == []


def test_driver_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 8
    assert set(contract.oracle_sql()) <= set(contract.queries())

