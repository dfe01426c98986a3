"""Inventory and gold tables over the derived retail tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stocktally.plans import build, costs, customers, purchasing, sales
from stocktally.session import shared_folder
from stocktally.sources.sinks import read_table, write_table
from workload.registry import add
from workload.tables import AS_OF, CFG

_QTY = {
    "qtyallocatedso": "quantity_allocated_to_so", "qtyallocatedpo": "quantity_allocated_to_po", "qtyallocatedmo": "quantity_allocated_to_mo",
    "qtyallocatedtosend": "quantity_allocated_to_send", "qtyallocatedtoreceive": "quantity_allocated_to_receive", "qtydropship": "quantity_dropship",
    "qtyonorderpo": "quantity_on_order_po", "qtyonorderso": "quantity_on_order_so", "qtyonordermo": "quantity_on_order_mo",
    "qtyonordertosend": "quantity_on_order_to_send", "qtyonordertoreceive": "quantity_on_order_to_receive", "qtyonhand": "quantity_on_hand",
    "qtynotavailable": "quantity_not_available", "qtynotavailabletopick": "quantity_not_available_to_pick", "qtycommitted": "quantity_committed",
    "qtyallocated": "total_quantity_allocated", "qtyonorder": "total_quantity_on_order",
}
_WIDE = ("quantity_on_hand quantity_allocated_po quantity_allocated_so quantity_allocated_mo quantity_allocated_transfer_order quantity_not_available "
         "quantity_not_available_to_pick quantity_dropship quantity_on_order_po quantity_on_order_so quantity_on_order_transfer_order quantity_on_order_mo")


def model(name: str, digits: str = "", query: str | None = None) -> None:
    add(query or name, lambda t: t[name], f"select * from {{{name}}}", digits)


for _m, _c in _QTY.items():
    model(f"inventory_{_m}", _c)
model("inventory_qtyinventory", _WIDE)
model("inventory_qtyinventorytotals", "quantity_on_hand quantity_allocated quantity_not_available quantity_not_available_to_pick quantity_dropship quantity_on_order")
model("inventory_qohview", "calculated_quantity_on_hand")
model("inventory_tagserialviewview")
model("f_inventoryview", "qty_available qty_not_available qty_on_order part_cost extended_cost")

model("int_magento_product_attributes")
model("int_magento_product_eav_lookups")
model("int_magento_product_taxonomy")
model("int_fishbowl_product_enrichment", "convert avgcost lastvendorcost")
model("d_product", "convert avgcost lastvendorcost")
model("int_product_analyst", "avgcost lastvendorcost")
model("d_product_bundle", "conversion_rate default_quantity")

model("int_fishbowl_magento_order_map")
_COST = ("cost_unique averageweightedcost_unique cost_duplicate averageweightedcost_duplicate cost_avg averageweightedcost_avg order_cost order_cost_average")
model("int_fishbowl_order_cost", _COST)
model("int_sales_cost_fallback", "fallback_unit_cost")
_FREIGHT = ("shipping_amount base_shipping_amount base_shipping_canceled base_shipping_discount_amount base_shipping_refunded base_shipping_tax_amount "
            "base_shipping_tax_refunded")
model("int_magento_order_freight", _FREIGHT + " net_sales freight_amount total_weight")
model("int_magento_product_conversion", "part_qty_sold conversion")
add("product_conversion_reference_key", lambda t: costs.product_conversion(t, CFG, reference_key=True), "select * from {pieces_by_shop_id}", "part_qty_sold conversion")

SALES_DIGITS = "conversion row_total cost qty_ordered freight_revenue freight_cost part_qty_sold testc testr testfr testfc"
model("int_fishbowl_gunbroker_sales", SALES_DIGITS)
add("shop_sales", lambda t: sales.shop_sales(t, CFG), "select * from {shop_sales}", SALES_DIGITS)
model("f_sales", SALES_DIGITS)
add("f_sales_realtime", lambda t: sales.sales_realtime(t, AS_OF, CFG), "select * from {f_sales_realtime}", SALES_DIGITS + " base_cost")
add("f_sales_increment", lambda t: sales.sales_increment(t, AS_OF, CFG),
    f"""select * from {{shop_sales}} where order_id in (select order_id from {{magento_sales_order_item}}
 where cast(((item_created_at) at time zone 'UTC') at time zone '{CFG.timezone}' as date) >= date '{AS_OF}' - {CFG.lookback_days})
 union all by name select * from {{int_fishbowl_gunbroker_sales}} where created_at >= date '{AS_OF}' - {CFG.lookback_days}""", SALES_DIGITS)
model("int_daily_sales_metrics", "daily_revenue daily_margin_pct")
model("v_daily_revenue", "total_revenue")
model("int_daily_sales_by_caliber", "units_sold")

model("f_pos", "qty unit_cost total_cost quantity_fulfilled quantity_to_fulfill vendor_lead_time vendor_product_leadtime product_leadtime precise_leadtime")
_SHIP = _FREIGHT + " freightamount net_amount packagenumb freightweight carrierserviceid"
model("f_shippment", _SHIP)
add("f_shippment_carrier_key", lambda t: purchasing.shipments(t, CFG, "carrier_id"), "select * from {f_shippment_by_carrier}", _SHIP)

model("int_customer_cohort")
model("f_cohort")
model("f_cohort_detailed")
add("f_cohort_all_sizes", lambda t: customers.cohort_activity(t["f_sales"], "rank_id", "created_at", all_sizes=True),
    "select f.*, s.cohort_size_all from {f_cohort} f join (select cohort_month, count(*) as cohort_size_all from {int_customer_cohort} where rank_id is not null group by 1) s using (cohort_month)")
_SEG = {"total_revenue": 4, "margin": 6}
add("d_customer_segmentation", lambda t: t["d_customer_segmentation"], "select * from {d_customer_segmentation}", _SEG)
add("segmentation_normalized_email", lambda t: customers.segmentation(t, AS_OF, CFG, normalize_email=True), "select * from {segmentation_normalized}", _SEG)
model("d_store")
add("d_customer", lambda t: t["d_customer"],
    "select " + ", ".join(f"{c} as {o}" for c, o in customers.CUSTOMER_COLUMNS.items()) + " from {magento_customer_entity}")
add("d_vendor", lambda t: t["d_vendor"], "select " + ", ".join(customers.VENDOR_COLUMNS) + " from {fishbowl_vendors}")


def _refreshed(t):
    """A stored table with older rows, some of them outdated, after two incremental runs: it equals a full build."""
    spark = t["orders"].sparkSession
    root = f"{shared_folder(spark)}/refresh-{uuid.uuid4().hex}"
    old = t["f_sales"].filter(F.col("created_at") < F.date_sub(F.lit(AS_OF).cast("date"), CFG.lookback_days - 2))
    recent = F.col("created_at") >= F.date_sub(F.lit(AS_OF).cast("date"), CFG.lookback_days)
    stale = old.withColumn("row_total", F.when(recent, F.col("row_total") + 1).otherwise(F.col("row_total")))
    write_table(build.sales_by_month(stale), f"{root}/f_sales", partition_by=["sold_month"])
    for _ in range(2):
        build.refresh(t, root, AS_OF, CFG)
    assert read_table(spark, f"{root}/segment_history").count() == t["d_customer_segmentation"].count()
    return build.stored_sales(t, root)


add("pipeline_refresh_equals_full", _refreshed, "select * from {f_sales}", SALES_DIGITS)
