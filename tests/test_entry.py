"""Driver contract: entry runs, every oracle key is a query key."""

import __spark_entry__ as E


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "net_revenue" in df.columns


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 120


def test_every_query_builds_a_plan(spark):
    """Analysis of every registered plan at the smallest scale (no full run)."""
    from conftest import SF_SMALL
    from finspark.plans.registry import load_all
    for name, fn in load_all().items():
        assert fn(spark, SF_SMALL).schema.fields, name
