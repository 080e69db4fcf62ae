"""Every registered query: equal to its SQL twin, or a non-empty result with stable columns."""

import pytest
from oracle import difference

from tarnwater.plans import REGISTRY

WITH_SQL = [name for name, q in REGISTRY.items() if q.sql is not None]
ROWS_ONLY = [name for name, q in REGISTRY.items() if q.sql is None]


@pytest.mark.parametrize("name", WITH_SQL)
def test_equals_sql(spark, small_dir, name):
    query = REGISTRY[name]
    assert difference(query(spark, small_dir), small_dir, query.sql) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_has_rows(spark, small_dir, name):
    df = REGISTRY[name](spark, small_dir)
    rows = df.collect()
    assert rows and all(list(r.asDict()) == df.columns for r in rows)
