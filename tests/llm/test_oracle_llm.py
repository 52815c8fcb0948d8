"""Queries against their SQL, and the columns that all queries promise."""

from __future__ import annotations

import pytest
from conftest import DATA
from oracle_check import compare, connect

from odsflow.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows_as_sql(spark, name):
    assert compare(QUERIES[name](spark, DATA), connect(DATA), SQL[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
