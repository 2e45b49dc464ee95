"""The driver contract: entry / queries / oracle_sql."""

import __spark_entry__ as E


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == ["product", "peak_mean", "annual_mean", "n_months", "premium"]
    assert df.count() > 0


def test_every_oracle_has_a_query_and_names_are_unique():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 90
    assert all(callable(f) for f in qs.values())
    assert all(isinstance(s, str) and s.strip() for s in sql.values())
