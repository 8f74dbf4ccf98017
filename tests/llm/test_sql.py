"""Queries that SQL can express, against it."""

import pytest

from checks.compare import connect, difference
from grainsieve.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
