"""Every named query against its DuckDB statement on the smallest data set."""

from __future__ import annotations

import pytest
from compare import compare, connect

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_matches_sql(spark, duck, name):
    assert compare(driver.queries()[name](spark, SF_DIR), duck, driver.oracle_sql()[name]) == []


def test_comparison_notices_a_difference(spark, duck):
    frame = driver.queries()["menu_avg"](spark, SF_DIR)
    broken = driver.oracle_sql()["menu_avg"].replace("clean_item_price > 0", "clean_item_price > 1")
    assert compare(frame, duck, broken)


def test_entry_and_names(spark):
    assert driver.entry(spark).limit(1).count() == 1
    assert set(driver.oracle_sql()) <= set(driver.queries())
