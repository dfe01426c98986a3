"""Tables that several models share: built once, and packed tight."""

from __future__ import annotations

from stocktally.plans import costs, sales
from stocktally.sources.tables import Tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_freight_of_orders_is_built_once(spark):
    from workload.tables import STORED, tables

    given = tables(spark, "/root/testdata/sf0.001")
    assert "int_order_shipments" in STORED
    for frame in (sales.marketplace_sales(given), costs.order_freight(given)):
        assert "tracking_number" not in _plan(frame)


def test_stored_tables_are_packed_tight(spark):
    made = Tables({"t": lambda t: spark.range(10)}).stored(["t"])
    files = [f for f in made["t"].inputFiles() if f.endswith(".parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
