"""Every registered query against its independent DuckDB SQL (small scale)."""

import pytest

from .conftest import SF_SMALL
from .oracle_check import compare


@pytest.mark.parametrize("sf_dir", [SF_SMALL])
def test_all_queries_match_oracle(spark, sf_dir):
    assert compare(spark, sf_dir, verbose=False) == []


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["customer_state", "order_count", "total_sales", "avg_order_value"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
