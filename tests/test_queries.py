"""Every registered query against its DuckDB oracle at sf0.001, and the entry point."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck
from tunelake.plans.catalog import ORACLE, QUERIES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["country", "genre", "total_streams"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, small_dir, name):
    con = duck(small_dir)
    r = compare(E.queries()[name](spark, small_dir), con, E.oracle_sql()[name])
    assert r["ok"], r
