"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

from __future__ import annotations

from helpers import SF_SMALL
from oracle_compare import compare

from ledgerstar.plans.catalog import registry


def test_all_queries_match_oracle(spark):
    results = compare(spark, SF_SMALL, list(registry()), verbose=False)
    bad = {k: r for k, r in results.items() if r["match"] is False}
    assert not bad, bad
    unchecked = [k for k, r in results.items() if r["match"] is None]
    assert unchecked == []
    assert all(r["spark_rows"] > 0 for r in results.values())


def test_entry_smoke(spark):
    import __spark_entry__ as ep

    df = ep.entry(spark)
    assert df.columns == ["year", "month", "month_name", "net_sales"]
    assert df.count() == 80
