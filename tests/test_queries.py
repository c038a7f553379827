"""Every registered query against SQL run by another engine."""

import pytest

import __spark_entry__ as entry
from compare import differences
from monthfusion.catalogue import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert differences(df, ORACLES[name], SMALL) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 35 and df.count() > 0
