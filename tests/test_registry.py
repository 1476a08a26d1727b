import __spark_entry__ as entry_points


def test_every_oracle_has_its_query():
    names = set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= names
    assert all(entry_points.oracle_sql().values())


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.count() == 200 and "drop_reason" in df.columns
