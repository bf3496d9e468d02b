"""Every registered query against its oracle, over whole tables."""

import pytest
from conftest import SMALL
from oracle import compare

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, duck):
    df = QUERIES[name](spark, SMALL)
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["id", "chamber", "last_name"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
