from __future__ import annotations

import pytest

import __spark_entry__ as entry
import check
from storelens.queries import QUERIES

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(ROOT)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["category_en", "gmv"] and rows.count() == 5


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, connection, name):
    problem, count, *_ = check.compare(spark, connection, name, ROOT)
    assert not problem, problem
    assert count
