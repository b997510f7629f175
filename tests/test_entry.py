import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) == {"plataforma", "group_kind", "groups", "capacity", "first_row_id"}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
