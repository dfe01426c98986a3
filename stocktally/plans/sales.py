"""Sales facts: shop items, marketplace orders, realtime slice, daily series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.functions.scalars import (
    channel, clock_text, normalized_email, safe_div, since_days, trunc_ntz, wall_clock,
)
from stocktally.operators.aggregates import margin_pct
from stocktally.operators.joins import groups_with_history, inherit_from_parent, with_scalar_row, without_groups
from stocktally.plans.costs import item_cost, net_row_total, order_shipments
from stocktally.session import cut_lineage
from stocktally.sources.tables import Tables

SALES_COLUMNS = (
    "created_at", "timedate", "id", "increment_id", "hour_start", "product_id", "order_id", "trickat",
    "product_options", "product_type", "parent_item_id", "testsku", "conversion", "hour_text", "customer_email",
    "postcode", "country", "region", "city", "street", "telephone", "customer_name", "store_id", "storefront",
    "status", "row_total", "cost", "qty_ordered", "freight_revenue", "freight_cost", "vendor", "customer_id",
    "rank_id", "part_qty_sold", "testc", "testr", "testfr", "testfc",
)
# Presentation names that differ from the column names.
SALES_LABELS = {"hour_start": "Início da Hora - Copiar", "hour_text": "Início da Hora"}


def _with_rank(df: DataFrame, t: Tables, cfg: RetailConfig) -> DataFrame:
    """Customer ids by normalized email."""
    ids = t["magento_d_customerupdated"].select(F.col("customer_email").alias("__email"), "rank_id")
    return df.withColumn("__email", normalized_email("customer_email", cfg.default_customer_email)).join(
        ids, "__email", "left"
    ).drop("__email")


def shop_items(t: Tables, cfg: RetailConfig = DEFAULT, order_ids: DataFrame | None = None) -> DataFrame:
    """Order items with cost and allocated freight, before parents hand down.

    `order_ids` limits the result to whole orders; an order is never cut.
    """
    items = t["magento_sales_order_item"]
    if order_ids is not None:
        items = items.join(order_ids, "order_id", "left_semi")
    tested = items
    items = items.select(
        "order_item_id", "order_id", "product_id", "parent_item_id", "product_type", "product_options",
        F.col("sku").alias("testsku"), "vendor_id", "store_id", F.col("item_weight").alias("weight"),
        F.col("base_cost").alias("cost_magento"),
        wall_clock("item_created_at", cfg.timezone).alias("timedate"),
        F.when(F.col("row_total") != 0, F.col("quantity_ordered")).otherwise(0).alias("ordered"),
        "quantity_ordered", net_row_total().alias("row_total"),
    )
    # Everything known per order is put together at order level, so the wide item
    # rows move once for it. The stand-in email of unknown customers is one hot
    # value; it is looked up there too, on narrow rows that adaptive joins can split.
    address = t["magento_sales_order_address"].select(
        F.col("order_address_id").alias("billing_address_id"), "postcode", F.col("country_code").alias("country"),
        "region", "city", F.col("street_address").alias("street"), F.col("phone_number").alias("telephone"),
    )
    freight = t["int_magento_order_freight"].select("order_id", "net_sales", "freight_amount", "total_weight", "product_count")
    orders = t["magento_sales_order"].select(
        "order_id", F.col("order_increment_id").alias("increment_id"), "billing_address_id", "customer_email",
        F.concat("customer_firstname", F.lit(" "), "customer_lastname").alias("customer_name"),
        F.upper("order_status").alias("status"), "customer_id",
    )
    orders = _with_rank(orders, t, cfg).join(address, "billing_address_id", "left").join(freight, "order_id", "left")
    orders = orders.withColumn("__known", F.lit(True))
    costs = t["int_item_costs"].drop("order_id", "magento_product_id")
    known_cost = [c for c in costs.columns if c != "order_item_id"]
    pieces = t["int_magento_product_conversion"].select(F.col("item_id").alias("order_item_id"), "part_qty_sold", "conversion")
    # Item facts first, then all that goes by order: the rows move once for each, with one cost instead of its six sources.
    rows = items.join(costs, "order_item_id", "left").withColumn("cost", item_cost("quantity_ordered")).drop(*known_cost)
    rows = rows.join(pieces, "order_item_id", "left").join(orders, "order_id", "left")
    rows = without_groups(rows, "order_id", F.col("sku").isin(list(cfg.excluded_order_skus)), tested)
    # An item without its order counts for the unknown customer.
    unknown = t["magento_d_customerupdated"].filter(F.col("customer_email") == cfg.default_customer_email.lower())
    rows = with_scalar_row(rows, unknown.agg(F.max("rank_id").alias("__unknown")))
    rows = rows.withColumn("rank_id", F.when(F.col("__known"), F.col("rank_id")).otherwise(F.col("__unknown"))).drop("__known", "__unknown")
    qty = F.when(F.col("row_total") == 0, 0).otherwise(F.col("ordered"))
    # Without order weight, freight is spread evenly over the items; the padded
    # protection SKU never takes an even share.
    even = F.col("total_weight").isNull() & ~F.col("testsku").ilike(cfg.unweighted_sku_pattern)
    amount = F.coalesce("freight_amount", "net_sales")
    n, w, whole = F.col("product_count"), F.col("weight"), F.col("total_weight")

    def share(value: Column) -> Column:
        by_count = safe_div(F.col("qty_ordered") * value, n * F.col("qty_ordered"))
        by_weight = safe_div(w * F.col("qty_ordered") * value, whole * F.col("qty_ordered"))
        return F.when(even, by_count).otherwise(by_weight)

    return (
        rows.withColumn("qty_ordered", qty)
        .withColumn("cost", F.when(F.col("ordered") > 0, F.col("cost")))
        .withColumn("freight_revenue", share(F.col("net_sales")))
        .withColumn("freight_cost", share(amount))
        .withColumn("conversion", F.coalesce("conversion", F.lit(1)))
        .drop("ordered", "quantity_ordered", "weight", "net_sales", "freight_amount", "total_weight", "product_count", "billing_address_id")
    )


def shop_sales(t: Tables, cfg: RetailConfig = DEFAULT, order_ids: DataFrame | None = None) -> DataFrame:
    """Shop branch of the sales table: simple items carry their parent's measures."""
    measures = ["row_total", "cost", "qty_ordered", "part_qty_sold", "freight_revenue", "freight_cost"]
    items = t["int_shop_items"] if order_ids is None else cut_lineage(shop_items(t, cfg, order_ids), "recent_items")
    resolved = inherit_from_parent(
        items, "order_item_id", "parent_item_id",
        F.col("product_type") == "configurable", measures,
    ).filter(F.col("product_type") != "configurable")
    fallback = t["int_sales_cost_fallback"]
    # One row per product, and only rows without a cost ask for it: the others do not move.
    lacking = F.col("cost").isNull()
    nothing = F.lit(None).cast(fallback.schema["fallback_unit_cost"].dataType)
    rows = resolved.filter(lacking).join(fallback, "product_id", "left").unionByName(
        resolved.filter(~lacking).withColumn("fallback_unit_cost", nothing)
    )
    return rows.select(
        F.col("timedate").cast("date").alias("created_at"), "timedate", F.col("order_item_id").alias("id"), "increment_id",
        trunc_ntz("hour", "timedate").alias("hour_start"), "product_id", "order_id", F.col("timedate").alias("trickat"),
        "product_options", "product_type", "parent_item_id", "testsku", "conversion",
        clock_text(F.date_trunc("hour", "timedate")).alias("hour_text"), "customer_email", "postcode", "country", "region",
        "city", "street", "telephone", "customer_name", "store_id",
        channel("increment_id", cfg.marketplace_prefix, cfg.marketplace_name, cfg.default_store_name).alias("storefront"),
        "status", "row_total",
        F.coalesce(F.col("cost"), F.col("fallback_unit_cost") * F.col("qty_ordered"), F.col("cost_magento")).alias("cost"),
        "qty_ordered", "freight_revenue", "freight_cost", F.col("vendor_id").alias("vendor"), "customer_id", "rank_id",
        F.coalesce("part_qty_sold", "qty_ordered").alias("part_qty_sold"), F.col("parent_cost").alias("testc"),
        F.col("parent_row_total").alias("testr"), F.col("parent_freight_revenue").alias("testfr"),
        F.col("parent_freight_cost").alias("testfc"),
    )


def marketplace_sales(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Orders that exist in the ERP only, in the shape of the sales table.

    Ids are negated so they never meet shop ids. Freight follows revenue share, or
    the number of lines when an order has no revenue.
    """
    orders = t["fishbowl_so"].filter(F.col("sales_order_number").startswith(cfg.marketplace_prefix)).select(
        "sales_order_id", F.col("sales_order_number").alias("increment_id"), F.col("status_id").alias("order_status"),
        "customer_email", F.col("customer_phone").alias("telephone"), F.col("bill_to_name").alias("customer_name"),
        F.col("bill_to_address").alias("street"), F.col("bill_to_city").alias("city"), F.col("bill_to_zip").alias("postcode"),
        wall_clock("created_at", cfg.timezone).alias("timedate"),
    )
    items = t["fishbowl_soitem"].filter(F.col("item_type_id") == cfg.sale_item_type_id).select(
        "so_item_id", "sales_order_id", F.col("product_id").alias("erp_product"), F.col("product_number").alias("testsku"),
        F.col("quantity_ordered").alias("qty_ordered"), F.col("total_price").alias("row_total"), F.col("total_cost").alias("cost"),
    )
    links = t["fishbowl_plugininfo"].filter(F.col("related_table_name") == "Product").select(
        F.col("record_id").alias("erp_product"), F.col("channel_id").cast("bigint").alias("shop_product")
    )
    to_base = t["fishbowl_uomconversion"].filter(F.col("to_uom_id") == cfg.base_uom_id).select(
        F.col("from_uom_id").alias("uom_id"), "multiply_factor"
    )
    units = t["fishbowl_product"].select(F.col("product_id").alias("erp_product"), "uom_id").join(to_base, "uom_id", "left").select(
        "erp_product", F.coalesce("multiply_factor", F.lit(1)).alias("unit_pieces")
    )
    own = items.join(_with_rank(orders, t, cfg), "sales_order_id")
    per_order = own.groupBy("sales_order_id").agg(F.sum("row_total").alias("order_total"), F.count(F.lit(1)).alias("order_lines"))
    freight = order_shipments(t).select("sales_order_id", F.col("freight_amount").alias("order_freight"))
    products = units.join(links, "erp_product", "full_outer")
    rows = own.join(per_order.join(freight, "sales_order_id", "left"), "sales_order_id").join(products, "erp_product", "left")
    status = F.col("order_status")
    by_revenue = F.col("order_freight") * (F.col("row_total") / F.nullif(F.col("order_total"), F.lit(0)))
    pieces = F.coalesce("unit_pieces", F.lit(1))

    def nothing(kind: str) -> Column:
        return F.lit(None).cast(kind)

    values = {
        "created_at": F.col("timedate").cast("date"), "timedate": F.col("timedate"), "id": -F.col("so_item_id"),
        "increment_id": F.col("increment_id"), "hour_start": trunc_ntz("hour", "timedate"),
        "product_id": F.coalesce(F.col("shop_product"), -F.col("erp_product")), "order_id": -F.col("sales_order_id"),
        "trickat": F.col("timedate"), "product_options": nothing("string"), "product_type": F.lit("simple"),
        "parent_item_id": nothing("bigint"), "testsku": F.col("testsku"), "conversion": pieces,
        "hour_text": clock_text(F.date_trunc("hour", "timedate")), "customer_email": F.col("customer_email"),
        "postcode": F.col("postcode"), "country": F.lit("US"), "region": nothing("string"), "city": F.col("city"),
        "street": F.col("street"), "telephone": F.col("telephone"), "customer_name": F.col("customer_name"),
        "store_id": nothing("int"), "storefront": F.lit(cfg.marketplace_name),
        "status": F.when(status.isin(20, 25), "PROCESSING").when(status.isin(30, 40, 60), "COMPLETE")
                   .when(status == 50, "CANCELED").otherwise("ESTIMATE"),
        "row_total": F.col("row_total"), "cost": F.col("cost"), "qty_ordered": F.col("qty_ordered"),
        "freight_revenue": nothing("double"),
        "freight_cost": F.when(F.col("order_total") > 0, by_revenue).otherwise(safe_div("order_freight", "order_lines")),
        "vendor": nothing("bigint"), "customer_id": nothing("bigint"), "rank_id": F.col("rank_id"),
        "part_qty_sold": F.col("qty_ordered") * pieces, "testc": nothing("double"), "testr": nothing("double"),
        "testfr": nothing("double"), "testfc": nothing("double"),
    }
    return rows.select(*[values[c].alias(c) for c in SALES_COLUMNS])


def sales(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    return shop_sales(t, cfg).unionByName(t["int_fishbowl_gunbroker_sales"])


def touched_orders(t: Tables, as_of: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Ids of shop orders with an item inside the lookback window."""
    recent = since_days(wall_clock("item_created_at", cfg.timezone), as_of, -cfg.lookback_days)
    return t["magento_sales_order_item"].filter(recent).select("order_id").distinct()


def sales_increment(t: Tables, as_of: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Rows to merge into the sales table.

    The window has no upper end: rows stamped after as_of belong to it. Whole orders are re-read when any of their items is recent, so a child never
    loses a parent that is older than the window.
    """
    shop = shop_sales(t, cfg, touched_orders(t, as_of, cfg))
    market = t["int_fishbowl_gunbroker_sales"].filter(since_days("created_at", as_of, -cfg.lookback_days))
    return shop.unionByName(market)


def sales_presentation(sales_rows: DataFrame) -> DataFrame:
    return sales_rows.withColumnsRenamed(SALES_LABELS)


def sales_realtime(t: Tables, as_of: str, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Last days of sales, each row with its day's and its day and SKU's order count."""
    recent = t["f_sales"].filter(F.col("created_at") >= F.date_sub(F.lit(as_of).cast("date"), cfg.realtime_days))
    # One pass: distinct (day, sku, order) rows, then both counts from them.
    triples = recent.select("created_at", "testsku", "order_id").distinct()
    by_day = triples.groupBy("created_at").agg(F.count_distinct("order_id").alias("distinct_order_id_count"))
    by_sku = triples.groupBy("created_at", "testsku").agg(F.count("order_id").alias("distinct_order_id_by_testsku"))
    return (
        recent.join(by_day, "created_at", "left").join(by_sku, ["created_at", "testsku"], "left")
        .withColumn("id_rfv", F.col("order_id")).withColumn("base_cost", F.col("cost"))
    )


def active(df: DataFrame, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Rows of orders that count as sales."""
    return df.filter(F.col("status").isin(list(cfg.valid_order_statuses)))


def daily_metrics(rows: DataFrame, day: str = "created_at", revenue: str = "row_total", cost: str = "cost", order: str = "order_id") -> DataFrame:
    """Revenue, distinct orders and margin per day; days without revenue are left out."""
    return (
        rows.groupBy(F.col(day).cast("date").alias("sale_date")).agg(
            F.sum(revenue).alias("daily_revenue"), F.count_distinct(order).alias("daily_orders"),
            margin_pct(revenue, cost).alias("daily_margin_pct"),
        ).filter(F.col("daily_revenue") > 0)
    )


def daily_revenue(rows: DataFrame, day: str = "created_at", revenue: str = "row_total") -> DataFrame:
    return rows.groupBy(F.col(day).cast("date").alias("sale_date")).agg(F.sum(revenue).alias("total_revenue"))


def daily_by_series(rows: DataFrame, series: str, day: str, units: str, min_days: int) -> DataFrame:
    """Units per day and series, for series with enough sale days."""
    named = rows.filter(F.col(series).isNotNull() & (F.col(series) != ""))
    daily = named.groupBy(F.col(day).cast("date").alias("sale_date"), series).agg(F.sum(units).alias("units_sold"))
    return groups_with_history(daily, [series], "sale_date", min_days)


def daily_by_caliber(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    products = t["int_product_analyst"].select("product_id", "caliber")
    return daily_by_series(
        active(t["f_sales"], cfg).select("created_at", "product_id", "qty_ordered").join(products, "product_id"),
        "caliber", "created_at", "qty_ordered", cfg.min_series_days,
    ).select("sale_date", "caliber", "units_sold")


def builders(cfg: RetailConfig = DEFAULT) -> dict:
    return {
        "int_shop_items": lambda t: shop_items(t, cfg),
        "int_fishbowl_gunbroker_sales": lambda t: marketplace_sales(t, cfg),
        "f_sales": lambda t: sales(t, cfg),
        "int_daily_sales_metrics": lambda t: daily_metrics(active(t["f_sales"], cfg)),
        "v_daily_revenue": lambda t: daily_revenue(active(t["f_sales"], cfg)),
        "int_daily_sales_by_caliber": lambda t: daily_by_caliber(t, cfg),
    }
