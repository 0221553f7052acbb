"""Every driver query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from strata.queries import ORACLE, QUERIES
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "ORDER_KEY" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res.startswith("OK"), res
