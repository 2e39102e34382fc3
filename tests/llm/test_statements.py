"""Queries with an SQL statement, next to DuckDB over the smallest tables."""

import os
import sys

import pytest

from cinelink.llm.statements import ORACLES

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
from check import compare, database  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_statement(spark, name):
    message, n = compare(spark, database(FOLDER), name, FOLDER)
    assert message is None and n > 0
