"""Driver contract: entry runs, every oracle names a query, names are unique."""

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "avg_los" in df.columns


def test_oracles_match_registered_queries():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 60
