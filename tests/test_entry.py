"""Driver contract: entry smoke run, catalogue and oracle keys."""

import __spark_entry__ as E
from stridelake.plans import catalogue


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "trial_id" in df.columns and df.count() > 0


def test_queries_have_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(catalogue.QUERIES) <= set(o)
