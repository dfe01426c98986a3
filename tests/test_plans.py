"""The shape of physical plans: pruning, limits before shuffles, no pairwise joins."""

import pytest

from workload.queries import QUERIES
from workload.tables import tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(spark, name):
    frame = QUERIES[name].run(tables(spark, FOLDER))
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "cdc_latest_filter_first", "top_n_per_key", "top_n_else_other", "earliest_per_key", "int_magento_product_taxonomy"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "WindowGroupLimit" in plan and ", Partial" in plan


# Joins of one-row aggregates; every other join is on keys.
SCALAR = {"cross_join_scalar", "table_parity", "kpi_set", "compare_today", "compare_mtd", "compare_ytd", "days_of_supply", "stock_overview", "low_stock", "overstock",
          "f_sales_increment"}


def test_no_pairwise_joins(spark):
    skip = ("stream_", "merge_", "archive_", "export_")  # these run jobs while they are built
    bad = []
    for name in QUERIES:
        if name in SCALAR or name.startswith(skip):
            continue
        plan = plan_of(spark, name)
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            bad.append(name)
    assert bad == []


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "filter_between")
    assert "GreaterThanOrEqual(o_totalprice,100000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_inventory_joins_each_header_once(spark):
    from stocktally.plans.inventory import quantities

    plan = quantities(tables(spark, FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    # Five line families, and per family at most one scan of the headers.
    assert plan.count("o_orderstatus") > 0
    assert plan.count("Join Inner") <= 16
