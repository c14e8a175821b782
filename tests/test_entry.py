import __spark_entry__ as registered


def test_entry_runs_and_every_sql_has_its_query(spark):
    assert registered.entry(spark).count() > 0
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert all(callable(f) for f in registered.queries().values())
