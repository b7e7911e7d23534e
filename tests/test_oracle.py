"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as E
from paths import SF_ORACLE
from oracle import compare

SQL = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck_oracle, name):
    ok, msg = compare(spark, duck_oracle, name, E.queries()[name], SQL[name], SF_ORACLE)
    assert ok, msg


def test_every_query_has_an_oracle_or_is_listed():
    from plaudit.plans import catalog
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["game", "positive", "negative", "total_reviews", "positive_ratio"]
    assert 0 < len(rows) <= 10
    ratios = [r.positive_ratio for r in rows]
    assert ratios == sorted(ratios, reverse=True)
