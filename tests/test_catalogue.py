"""Every registered query against its SQL twin, and the driver's contract."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, duckdb_tables  # noqa: E402

from cambist.catalogue.oracles import ORACLES  # noqa: E402
from cambist.catalogue.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_tables(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name).startswith("equal")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark, sf_dir):
    frame = entry.entry(spark)
    assert frame.columns[:2] == ["revenue_date", "merchant_id"] and frame.count() > 0
