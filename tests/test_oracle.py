"""Every registered query against its DuckDB oracle on the driver tables."""

import pytest

from vendorlens.plans.registry import all_queries
from tests.oracle_check import compare

NAMES = sorted(all_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, sf_dir, name):
    ok, line = compare(spark, duck, name, all_queries()[name], sf_dir)
    assert ok, line


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["VendorNumber", "VendorName", "GrossProfit", "ProfitMargin", "TotalSalesDol_in_summary"]


def test_every_query_has_an_oracle():
    assert not [n for n, q in all_queries().items() if q.sql is None]
