"""Queries whose rows SQL can give, against it."""

import pytest

from flotilla.llm.queries import ORACLES, QUERIES
from tests.oracle import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_given_rows_equal_the_sql(spark, name):
    problems = compare(spark, name, QUERIES[name], ORACLES[name], SMALL, verbose=False)
    assert not problems, problems
