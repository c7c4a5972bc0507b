"""Queries against their SQL over whole tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

from coursegrain.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) == []
