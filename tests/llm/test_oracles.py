"""The queries that SQL can express, against it, over the test tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracles import compare, duckdb_tables  # noqa: E402

from cambist.llm.queries import ORACLES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, duckdb_tables(sf_dir), sf_dir, name).startswith("equal")
