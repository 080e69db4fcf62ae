"""The driver contract."""

import __spark_entry__ as contract


def test_contract_functions(spark):
    df = contract.entry(spark)
    assert df.columns == ["suffix", "host", "n"] and df.count() > 0
    queries, sql = contract.queries(), contract.oracle_sql()
    assert set(sql) <= set(queries)
    assert all(callable(q) for q in queries.values())
