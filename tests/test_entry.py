import __spark_entry__ as entry


def test_contract_keys():
    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 40


def test_entry_runs_on_smallest_scale(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "IMPS" in df.columns and "DATETIME" in df.columns
