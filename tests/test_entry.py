import __spark_entry__ as entry


def test_entry_runs_with_rows(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["c_customer_id"]


def test_contract_shapes():
    q, o = entry.queries(), entry.oracle_sql()
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())
