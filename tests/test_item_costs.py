"""Costs of shop items: values by hand, and rows that move once by item."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from stocktally.plans import costs
from stocktally.sources.tables import Tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def linked(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    def link(item):
        return f'{{"25": {{"value": "{item}"}}}}'

    return Tables(None, {
        "magento_sales_order_item": frame(
            [(11, 1, 105, 9.0), (11, 2, 105, 9.0), (12, 1, 105, 9.0), (12, 1, 106, 0.0), (12, 1, 999, 9.0), (12, 1, None, 9.0), (13, 3, 105, 9.0), (14, 3, 105, 9.0),
             (None, 3, 105, 9.0), (15, None, 105, 9.0)],
            "order_item_id long, order_id long, product_id long, row_total double"),
        "fishbowl_soitem": frame(
            [(1, 1, 5, "x", 2.0, 10.0, 10, link(11)), (2, 1, 5, "x", 1.0, 4.0, 10, link(12)), (3, 1, 6, "x", 1.0, 8.0, 20, link(12)), (4, 1, 5, "x", 1.0, 1.0, 20, link("013")),
             (5, 1, 5, "x", 1.0, 0.0, 20, None), (6, 1, 7, "x", 1.0, 6.0, 20, link(12)), (7, 1, 5, "x", 1.0, 3.0, 20, ""), (8, 1, 5, "x", 1.0, 3.0, 20, "not json"),
             (9, None, None, None, None, None, None, link(15))],
            "so_item_id long, sales_order_id long, product_id long, product_description string, quantity_ordered double, total_cost double, item_type_id int, custom_fields string"),
        "fishbowl_plugininfo": frame(
            [(4, "13", "SOItem"), (5, "14", "SOItem"), (5, "14", "SOItem"), (7, "+11", "SOItem"), (5, "105", "Product"), (6, "106", "Product"), (9, "0105", "Product")],
            "record_id long, channel_id string, related_table_name string"),
        "fishbowl_uomconversion": frame([(1, 1, 1.0)], "from_uom_id int, to_uom_id int, multiply_factor double"),
        "fishbowl_product": frame([(5, 50, 1), (6, 60, 1), (7, 70, 1)], "product_id long, part_id long, uom_id int"),
        "fishbowl_partcost": frame([(50, 0.5), (60, 0.25)], "part_id long, average_cost double"),
        "fishbowl_objecttoobject": frame([(1, 5, 30)], "object1_record_id long, object2_record_id long, relationship_type_id int"),
    })


def test_costs_of_items_with_one_line_several_or_none(linked):
    got = costs.item_costs(linked)
    assert got.columns == ["order_item_id", "order_id", "magento_product_id", "cost_unique", "averageweightedcost_unique", "cost_duplicate",
                           "averageweightedcost_duplicate", "cost_avg", "averageweightedcost_avg"]
    none = (None,) * 6
    several = (None, None, 4.0, 0.5, 6.0, 0.375)
    want = [
        (11, 1, 105, 10.0, 0.5, None, None, None, None), (11, 2, 105, 10.0, 0.5, None, None, None, None),
        (12, 1, 105, *several), (12, 1, 106, None, None, 8.0, 0.25, None, None),  # without revenue no mean of the products
        (12, 1, 999, None, None, None, None, 6.0, 0.375), (12, 1, None, None, None, None, None, 6.0, 0.375),  # a line without a product is no line of theirs
        (13, 3, 105, *none),  # "013" is not its text, and the line's own link hides the plugin's
        (14, 3, 105, None, None, 10.0, 0.5, 10.0, 0.5),  # the plugin names the line twice; it is a kit of line 1
        (None, 3, 105, *none), (15, None, 105, *none),
    ]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_lines_and_items_move_once_by_item(linked):
    moved = [m for m in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(costs.item_costs(linked))) if "shop_item" in m]
    assert len(moved) == 2 and sorted("shop_product" in m for m in moved) == [False, True]


def test_texts_that_name_ids_by_text(linked):
    """Ids that are texts are matched as texts."""
    items = linked["magento_sales_order_item"].withColumn("order_item_id", F.when(F.col("order_item_id") == 13, F.lit("013")).otherwise(F.col("order_item_id").cast("string")))
    linked.put("magento_sales_order_item", items)
    got = {r.order_item_id: r.cost_unique for r in costs.item_costs(linked).filter("order_item_id in ('013', '11')").collect()}
    assert got == {"013": 1.0, "11": 10.0}
