"""Every registered query against its SQL, every value exactly equal."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
OTHERS = {*entry.llm.queries(), "pipeline"} if entry.llm else set()  # tested in tests/llm
QUERIES = {name: query for name, query in entry.queries().items() if name not in OTHERS}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name not in OTHERS}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_no_placeholder_is_left():
    assert not [name for name, sql in SQL.items() if re.search(r"@\w+@", sql)]


def test_every_query_has_a_check():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert [r["漏斗层级"] for r in rows] == ["浏览pv", "收藏fav", "加购cart", "购买buy"]
