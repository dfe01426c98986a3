"""Purchase receipts with lead times, order shipping facts, reorder advice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.functions.scalars import ladder, uom_convert, wall_clock
from stocktally.operators.windows import first_per_key, previous_value, top_per_key
from stocktally.plans.costs import shipment_costs
from stocktally.session import cut_lineage
from stocktally.sources.tables import Tables


def with_lead_times(
    rows: DataFrame, vendor: str, part: str, started: str, received: str, n: int, tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Lead time by vendor and part, by vendor, by part, and the most precise of them.

    A lead time is the mean number of days from start to receipt over the newest n
    receipts, rounded up. The newest receipts of a vendor, and of a part, are among
    the newest of its vendor-part pairs, so all three levels are ranked on that
    reduced set, and are put together per pair: the wide rows move once for them.
    """
    order = [F.col(received).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in tiebreak]]
    known = rows.filter(F.col(received).isNotNull() & F.col(started).isNotNull()).select(vendor, part, started, received, *tiebreak)
    newest = cut_lineage(top_per_key(known, [vendor, part], order, n), "newest", "zstd")

    def level(keys: Sequence[str], out: str) -> DataFrame:
        top = newest if len(keys) == 2 else top_per_key(newest, keys, order, n)
        return top.groupBy(*keys).agg(F.ceil(F.avg(F.datediff(received, started))).alias(out))

    pairs = rows.select(vendor, part).distinct()
    levels = {"vendor_product_leadtime": [vendor, part], "vendor_lead_time": [vendor], "product_leadtime": [part]}
    for out, keys in levels.items():
        pairs = pairs.join(level(keys, out), keys, "left")
    pairs = pairs.select(F.col(vendor).alias("__vendor"), F.col(part).alias("__part"), *levels)
    same = F.col(vendor).eqNullSafe(F.col("__vendor")) & F.col(part).eqNullSafe(F.col("__part"))
    others = [c for c in rows.columns if c not in (vendor, part)]
    return rows.join(pairs, same, "left").select(
        part, vendor, *others, *levels, F.coalesce(*levels).alias("precise_leadtime")
    )


def receipt_lines(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Received or expected purchase lines with the receipt before them."""
    heads = t["fishbowl_receipt"].filter(F.col("order_type_id") == cfg.receipt_order_type_id).select(
        "receipt_id", "location_group_id"
    )
    po = t["fishbowl_po"].select(
        "purchase_order_id", "vendor_id", F.col("created_at").alias("po_created_at"),
        F.col("confirmed_at").alias("po_confirmed_at"), F.col("issued_at").alias("po_issued_at"),
        F.col("first_ship_date").alias("po_first_shipment_date"),
    )
    po_items = t["fishbowl_poitem"].select(
        "po_item_id", "purchase_order_id", "unit_cost", "total_cost", "last_fulfillment_date", "scheduled_fulfillment_date",
        "quantity_fulfilled", F.col("quantity_ordered").alias("quantity_to_fulfill"),
    ).join(po, "purchase_order_id", "left")
    parts = t["fishbowl_part"].select("part_id", "part_number", "default_uom_id")
    conversions = t["fishbowl_uomconversion"].select(
        F.col("to_uom_id").alias("default_uom_id"), F.col("from_uom_id").alias("uom_id"), "multiply_factor", "factor"
    )
    received = t["fishbowl_receiptitem"].filter(F.col("receipt_item_status_id").isin(list(cfg.receipt_statuses))).select(
        "receipt_item_id", "receipt_id", F.col("part_id"), "po_item_id", "uom_id", "quantity_received",
        "receipt_item_status_id", F.col("reconciled_at").alias("datereconciled"),
        F.col("received_at").alias("datereceived"), F.col("last_modified_at").alias("datelastmodified"),
    ).join(heads, "receipt_id")
    stepped = previous_value(received, ["po_item_id"], "datereceived", "datereceived", "__prior", ["receipt_item_id"])
    qty = uom_convert("quantity_received", "uom_id", "default_uom_id", "multiply_factor", "factor", zero_factor_as_one=True)
    return (
        stepped.join(po_items, "po_item_id", "left").join(parts, "part_id", "left")
        .join(conversions, ["default_uom_id", "uom_id"], "left")
        .withColumn("qty", F.coalesce(qty, F.lit(0)))
        .withColumn("last_date_prior_to_received", F.coalesce("__prior", "po_created_at"))
    )


def purchase_receipts(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """One row per received or expected purchase line, with lead times."""
    timed = with_lead_times(
        t["int_receipt_lines"], "vendor_id", "part_number", "last_date_prior_to_received", "datereceived",
        cfg.lead_time_rank_limit, ["receipt_item_id"],
    )
    expected = F.col("last_date_prior_to_received") + F.make_dt_interval(F.col("precise_leadtime").cast("int"))
    return timed.withColumn("date_expected", expected).select(
        "part_id", "receipt_item_id", "location_group_id", "qty", "datereconciled", "part_number", "datereceived",
        "datelastmodified", "unit_cost", "total_cost", "last_fulfillment_date", "scheduled_fulfillment_date",
        "quantity_fulfilled", "quantity_to_fulfill", "vendor_id", "po_created_at", "po_confirmed_at", "po_issued_at",
        "po_first_shipment_date", "purchase_order_id", "receipt_item_status_id", "po_item_id",
        "last_date_prior_to_received", "vendor_lead_time", "vendor_product_leadtime", "product_leadtime",
        "precise_leadtime", "date_expected",
    )


def shipments(t: Tables, cfg: RetailConfig = DEFAULT, carrier_key: str = "carrier_service_id") -> DataFrame:
    """Shipping facts per shop order.

    The carrier service is found by the rounded mean service id of the order's
    shipments. `carrier_key="carrier_id"` matches it against the carrier id instead,
    for parity with existing numbers.
    """
    rates = t["magento_quote_shipping_rate"]
    codes = rates.groupBy(F.col("quote_shipping_rate_code").alias("shipping_information")).agg(
        F.max("method").alias("method"), F.max("carrier_title").alias("carrier_title")
    )
    free_address = rates.filter(F.col("method_title").ilike("%Free%")).select(F.col("quote_address_id")).distinct()
    free_quotes = (
        t["magento_quote_address"].select("quote_id", "quote_address_id").join(free_address, "quote_address_id", "left_semi")
        .select("quote_id").distinct().withColumn("is_free_quote", F.lit(True))
    )
    address = t["magento_sales_order_address"].filter(F.col("address_type") == "shipping").select(
        F.col("order_address_id").alias("billing_address"), "postcode", F.col("country_code").alias("country"), "region",
        "city", F.col("phone_number").alias("telephone"),
    )
    per_ship = shipment_costs(t, ("shipment_id", "sales_order_id"), "freight_weight").withColumnRenamed("sales_order_id", "fishbowl_so_id")
    freight = (
        t["int_fishbowl_magento_order_map"].join(per_ship, "fishbowl_so_id", "left")
        .groupBy(F.col("magento_order_id").alias("order_id")).agg(
            F.avg("freight_amount").alias("freightamount"), F.avg("freight_weight").alias("freightweight"),
            F.avg("carrier_service_id").alias("carrierserviceid"), F.avg("net_amount").alias("net_amount"),
            F.avg("package_count").alias("packagenumb"),
        )
    )
    grid = t["magento_sales_shipment_grid"].select(
        "order_id", F.col("shipment_status_code").alias("shipment_status"),
        F.col("shipping_address_text").alias("shipping_address"), "shipping_name",
        F.col("shipping_information").alias("shipping_information2"),
    )
    quotes = t["magento_quote"].select(F.col("entity_id").alias("quote_id"), "ext_shipping_info")
    services = t["fishbowl_carrierservice"].select(
        F.col(carrier_key).cast("bigint").alias("__service"), F.col("carrier_id").alias("idcarrier"),
        F.col("carrier_service_name").alias("carrierservice"),
    )
    amounts = ("shipping_amount", "base_shipping_amount", "base_shipping_canceled", "base_shipping_discount_amount",
               "base_shipping_refunded", "base_shipping_tax_amount", "base_shipping_tax_refunded")
    orders = t["magento_sales_order"].filter(F.col("order_id").isNotNull()).select(
        *[F.coalesce(a, F.lit(0)).alias(a) for a in amounts], F.col("order_increment_id").alias("id"), "order_id",
        "customer_email", wall_clock("created_at", cfg.timezone).alias("created_at"),
        F.concat("customer_firstname", F.lit(" "), "customer_lastname").alias("customer_name"),
        F.col("shipping_address_id").alias("billing_address"), F.col("shipping_method").alias("shipping_information"),
        "store_id", "shipping_description", F.col("order_status").alias("status"), "quote_id",
        F.when(F.col("base_subtotal") >= cfg.free_shipping_threshold, "Yes").otherwise("No").alias("isfree"),
    )
    joined = (
        orders.join(grid, "order_id", "left").join(freight, "order_id", "left").join(codes, "shipping_information", "left")
        .join(address, "billing_address", "left").join(quotes, "quote_id", "left").join(free_quotes, "quote_id", "left")
        .withColumn("__service", F.round("carrierserviceid").cast("bigint")).join(services, "__service", "left")
    )
    return joined.withColumn("isfreeauto", F.when(F.col("is_free_quote"), "Yes").otherwise("No")).select(
        *amounts, "id", "order_id", "customer_email", "created_at", "customer_name", "billing_address",
        "shipping_information", "store_id", "shipping_description", "shipment_status", "shipping_address", "shipping_name",
        "status", "shipping_information2", "method", "carrier_title", "postcode", "country", "region", "city", "telephone",
        "freightamount", "net_amount", "packagenumb", "freightweight", "ext_shipping_info", "isfree", "carrierserviceid",
        "isfreeauto", "idcarrier", "carrierservice",
    )


def _stock_by_series(t: Tables) -> DataFrame:
    products = t["int_product_analyst"].filter(F.col("caliber").isNotNull() & (F.col("caliber") != "")).select("sku", "caliber")
    return t["f_inventoryview"].join(products, F.col("part_number") == F.col("sku")).groupBy("caliber").agg(
        F.sum(F.coalesce("qty_available", F.lit(0))).alias("qty_available"),
        F.sum(F.coalesce("qty_on_order", F.lit(0))).alias("qty_on_order"),
        F.sum("extended_cost").alias("inventory_value"),
    )


def demand_ahead(forecast: DataFrame, as_of: str, days: int = 30, series: str = "caliber") -> DataFrame:
    """Predicted demand over the coming days per series."""
    anchor = F.lit(as_of).cast("date")
    ahead = forecast.filter(
        (F.col("forecast_type") == "caliber") & (F.col("forecast_date") > anchor)
        & (F.col("forecast_date") <= F.date_add(anchor, days))
    )
    return ahead.groupBy(series).agg(
        F.sum("predicted_units").alias("demand_30d"), F.sum("upper_bound").alias("demand_upper_30d"),
        F.avg("predicted_units").alias("daily_avg_predicted"),
    )


def urgency(days_of_supply: Column, lead_time: Column, cfg: RetailConfig = DEFAULT) -> Column:
    return ladder([
        (days_of_supply <= lead_time, "Critical"), (days_of_supply <= lead_time * 2, "Warning"),
        (days_of_supply > cfg.overstock_days, "Overstock"),
    ], "OK")


def reorder_advice(
    demand: DataFrame, stock: DataFrame, vendors: DataFrame, as_of: str, series: str = "caliber", cfg: RetailConfig = DEFAULT,
) -> DataFrame:
    """Quantity to reorder per series: upper demand less stock and open orders.

    `vendors` has avg_lead_time, avg_unit_cost per (series, vendor_id); the fastest
    vendor is recommended.
    """
    best = first_per_key(vendors, [series], [F.col("avg_lead_time").asc_nulls_last(), F.col("vendor_id").asc_nulls_last()])
    zero = F.lit(0)
    base = demand.join(stock, series, "left").join(best, series, "left").select(
        series, F.coalesce("qty_available", zero).alias("qty_available"), F.coalesce("qty_on_order", zero).alias("qty_on_order"),
        F.round("demand_upper_30d", 0).alias("demand_upper_30d"), F.col("daily_avg_predicted").alias("__daily"),
        F.round("daily_avg_predicted", 1).alias("daily_avg_predicted"),
        F.coalesce("avg_lead_time", F.lit(cfg.default_lead_time_days)).alias("lead_time_days"),
        F.col("vendor_id").alias("recommended_vendor_id"), F.coalesce("avg_unit_cost", zero).alias("avg_unit_cost"),
    )
    sells = F.col("__daily") > 0
    supply = F.col("qty_available") / F.col("__daily")
    slack = F.greatest(F.round(supply) - F.col("lead_time_days"), F.lit(0)).cast("int")
    sized = base.withColumn(
        "reorder_qty", F.greatest(F.lit(0), F.col("demand_upper_30d") - F.col("qty_available") - F.col("qty_on_order"))
    ).withColumn("days_of_supply", F.when(sells, F.round(supply, 1))).withColumn(
        "reorder_by", F.when(sells, F.date_add(F.lit(as_of).cast("date"), slack))
    )
    return sized.withColumn("urgency", urgency(F.col("days_of_supply"), F.col("lead_time_days"), cfg)).withColumn(
        "estimated_order_cost",
        F.when(F.col("reorder_qty") > 0, F.round(F.col("reorder_qty") * F.col("avg_unit_cost"), 2)).otherwise(0),
    ).drop("__daily")


def vendor_history(t: Tables) -> DataFrame:
    """Mean lead time and unit cost per caliber and vendor."""
    products = t["int_product_analyst"].filter(F.col("caliber").isNotNull() & (F.col("caliber") != "")).select("sku", "caliber")
    receipts = t["f_pos"].filter(F.col("precise_leadtime").isNotNull() & F.col("vendor_id").isNotNull())
    return receipts.join(products, F.col("part_number") == F.col("sku")).groupBy("caliber", "vendor_id").agg(
        F.round(F.avg("precise_leadtime"), 0).alias("avg_lead_time"), F.avg("unit_cost").alias("avg_unit_cost")
    )


def reorder_recommendations(t: Tables, as_of: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    advice = reorder_advice(
        demand_ahead(t["f_forecast"], as_of).drop("demand_30d"), _stock_by_series(t).drop("inventory_value"),
        vendor_history(t), as_of, "caliber", cfg,
    )
    names = t["d_vendor"].select(F.col("vendor_id").alias("recommended_vendor_id"), F.col("vendor_name").alias("recommended_vendor"))
    return advice.join(names, "recommended_vendor_id", "left").withColumn("refreshed_at", F.lit(as_of).cast("timestamp"))


def stockout_risk(
    stock: DataFrame, demand: DataFrame, lead_times: DataFrame, as_of: str, series: str = "caliber", cfg: RetailConfig = DEFAULT,
) -> DataFrame:
    """Days of supply against lead time for every series in stock."""
    rows = stock.filter(F.col("qty_available") > 0).join(demand, series, "left").join(lead_times, series, "left")
    lead = F.coalesce("avg_lead_time_days", F.lit(cfg.default_lead_time_days))
    sells = F.col("daily_avg_predicted") > 0
    supply = F.when(sells, F.col("qty_available") / F.col("daily_avg_predicted"))
    slack = F.greatest(F.round(supply) - lead, F.lit(0)).cast("int")
    return rows.select(
        series, F.col("qty_available").alias("qty_on_hand"), "qty_on_order",
        F.round("inventory_value", 2).alias("inventory_value"), F.round("demand_30d", 0).alias("demand_30d"),
        F.round("daily_avg_predicted", 1).alias("daily_avg_predicted"), F.round(supply, 1).alias("days_of_supply"),
        lead.alias("lead_time_days"), F.when(sells, F.date_add(F.lit(as_of).cast("date"), slack)).alias("reorder_by"),
        urgency(supply, lead, cfg).alias("risk_level"),
    )


def caliber_stockout_risk(t: Tables, as_of: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    lead = vendor_lead_by_series(t)
    return stockout_risk(_stock_by_series(t), demand_ahead(t["f_forecast"], as_of), lead, as_of, "caliber", cfg)


def vendor_lead_by_series(t: Tables) -> DataFrame:
    products = t["int_product_analyst"].filter(F.col("caliber").isNotNull()).select("sku", "caliber")
    return (
        t["f_pos"].filter(F.col("precise_leadtime").isNotNull()).join(products, F.col("part_number") == F.col("sku"))
        .groupBy("caliber").agg(F.round(F.avg("precise_leadtime"), 0).alias("avg_lead_time_days"))
    )


def builders(cfg: RetailConfig = DEFAULT) -> dict:
    return {"int_receipt_lines": lambda t: receipt_lines(t, cfg), "f_pos": lambda t: purchase_receipts(t, cfg), "f_shippment": lambda t: shipments(t, cfg)}
