"""Operators that SQL can express, against SQL run by another engine."""

import pytest

from compare import differences
from monthfusion.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), ORACLES[name], SMALL) == []
