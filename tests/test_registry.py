import __spark_entry__ as entry


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["event_category"] for r in rows} == {"authentication", "security", "network", "system", "other"}
