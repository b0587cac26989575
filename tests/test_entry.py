def test_entry_without_a_session_and_flagship(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["recording_id", "line_idx", "t", "speaker"]
