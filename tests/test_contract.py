"""Driver contract: entry smoke, query/oracle pairing, every query vs DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from ledgerlake.plans.queries import QUERIES
from oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 32
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_all_queries_match_oracle(spark):
    res = compare(spark, SF, sorted(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v["ok"] is not True}
    assert not bad, bad
