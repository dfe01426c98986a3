"""Order mapping, item cost, cost fallback, freight and piece conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from stocktally.config import DEFAULT, RetailConfig
from stocktally.functions.scalars import blank_to_null, json_text, safe_div, wall_clock
from stocktally.operators.joins import inherit_from_parent, rows_on_latest
from stocktally.sources.tables import Tables

MONEY = "decimal(38,9)"


def order_map(t: Tables) -> DataFrame:
    """ERP orders and the shop orders whose number starts theirs."""
    erp = t["fishbowl_so"].select(
        F.col("sales_order_id").alias("fishbowl_so_id"),
        F.split_part("sales_order_number", F.lit("-"), F.lit(1)).alias("number"),
    )
    shop = t["magento_sales_order"].select(
        F.col("order_id").alias("magento_order_id"), F.col("order_increment_id").cast("string").alias("number")
    )
    return erp.join(shop, "number").select("fishbowl_so_id", "magento_order_id")


def _spelled(text: Column, kind: T.DataType) -> Column:
    """The id of a type that has just this text; NULL for any other text, which equals no id's. Ids move in less room than texts."""
    number = text.try_cast(kind)
    return F.when(number.cast("string") == text, number) if isinstance(kind, T.IntegralType) else text


def _erp_item_costs(t: Tables, cfg: RetailConfig, item_kind: T.DataType) -> DataFrame:
    """Cost and weighted cost of the ERP lines that point to a shop item, with the shop ids they point to."""
    facts = ("so_item_id", "product_id", "product_description", "quantity_ordered", "total_cost", "item_type_id")
    # Step by step, so that each document is parsed once.
    lines = t["fishbowl_soitem"].select(*facts, json_text("custom_fields", "25", "value").alias("link"))
    lines = lines.select(*facts, blank_to_null("link").alias("link"))
    lines = lines.select(*facts, F.col("link").isNotNull().alias("has_link"), _spelled(F.col("link"), item_kind).alias("own_item"))
    plugin = t["fishbowl_plugininfo"].select("record_id", "channel_id", "related_table_name")
    line_link = plugin.filter(F.col("related_table_name") == "SOItem").select(
        F.col("record_id").alias("so_item_id"), _spelled(F.col("channel_id"), item_kind).alias("plugin_item")
    )
    product_link = plugin.filter(F.col("related_table_name") == "Product").select(
        F.col("record_id").alias("product_id"), F.col("channel_id").alias("shop_product")
    )
    to_base = t["fishbowl_uomconversion"].filter(F.col("to_uom_id") == cfg.base_uom_id).select(
        F.col("from_uom_id").alias("uom_id"), "multiply_factor"
    )
    weighted = (
        t["fishbowl_product"].select("product_id", "part_id", "uom_id")
        .join(t["fishbowl_partcost"].select("part_id", "average_cost"), "part_id", "left")
        .join(to_base, "uom_id", "left")
        .select("product_id", F.coalesce(F.col("average_cost") * F.col("multiply_factor"), F.col("average_cost")).alias("unit_weighted"))
    )
    # Product facts are joined to each other first and to the lines once.
    priced = lines.join(weighted.join(product_link, "product_id", "full_outer"), "product_id", "left")

    kit_links = t["fishbowl_objecttoobject"].filter(F.col("relationship_type_id") == cfg.kit_relationship_type_id).select(
        F.col("object1_record_id").alias("so_item_id"), F.col("object2_record_id").alias("kit_item")
    )
    components = priced.filter(
        (F.col("item_type_id") == cfg.sale_item_type_id)
        & ~F.col("product_description").ilike(cfg.cost_exclude_product_pattern)
    )
    def money(name: str) -> Column:
        return F.col(name).cast(MONEY)

    kits = (
        components.join(kit_links, "so_item_id").groupBy(F.col("kit_item").alias("so_item_id")).agg(
            F.coalesce(
                F.nullif(F.sum(money("total_cost")), F.lit(0)),
                F.sum(money("quantity_ordered") * money("unit_weighted")),
            ).alias("kit_cost"),
            F.sum("unit_weighted").alias("kit_weighted"),
        )
    )
    # A line whose own link is no item's id points nowhere, whatever the plugin says.
    return (
        priced.join(line_link, "so_item_id", "left").join(kits, "so_item_id", "left")
        .select(
            F.when(F.col("has_link"), F.col("own_item")).otherwise(F.col("plugin_item")).alias("shop_item"), "shop_product",
            F.when(F.col("total_cost") == 0, F.col("kit_cost")).otherwise(F.col("total_cost")).alias("cost"),
            F.coalesce("kit_weighted", "unit_weighted").alias("weighted"),
        )
        .filter(F.col("shop_item").isNotNull())
    )


def item_costs(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Cost of each shop item from the ERP lines that point to it.

    A shop item matched by one line takes that line's cost. With several lines the
    cost is averaged per product, and averaged again over products as a fallback.
    One aggregation per (item, product) carries every case. Its sums and the items
    then move once, by item: what an item's sums add up to, and the sum of its own
    product, are read from the rows beside it instead of being joined to it.
    """
    items = t["magento_sales_order_item"].select("order_item_id", "order_id", "product_id", "row_total")
    kinds = {f.name: f.dataType if isinstance(f.dataType, T.IntegralType) else T.StringType() for f in items.schema}
    by_product = _erp_item_costs(t, cfg, kinds["order_item_id"]).groupBy("shop_item", "shop_product").agg(
        F.count(F.lit(1)).alias("lines"),
        F.avg("cost").alias("p_cost"), F.avg("weighted").alias("p_weighted"),
        F.max("cost").alias("one_cost"), F.max("weighted").alias("one_weighted"),
    ).withColumn("shop_product", _spelled(F.col("shop_product"), kinds["product_id"]))
    named = items.withColumn("asks", F.lit(True)).withColumns({
        "shop_item": F.col("order_item_id").cast(kinds["order_item_id"]), "shop_product": F.col("product_id").cast(kinds["product_id"]),
    })
    item, pair = Window.partitionBy("shop_item"), Window.partitionBy("shop_item", "shop_product")
    beside = (
        by_product.unionByName(named.filter(F.col("shop_item").isNotNull()), allowMissingColumns=True)
        .withColumns({
            "lines": F.sum("lines").over(item), "a_cost": F.avg("p_cost").over(item), "a_weighted": F.avg("p_weighted").over(item),
            "u_cost": F.max("one_cost").over(item), "u_weighted": F.max("one_weighted").over(item),
        })
        .withColumns({c: F.when(F.col("shop_product").isNotNull(), F.max(c).over(pair)) for c in ("p_cost", "p_weighted")})
        .filter(F.col("asks"))
    )
    # An item without an id meets no line and does not move.
    rows = beside.unionByName(named.filter(F.col("shop_item").isNull()), allowMissingColumns=True)
    single, several = F.col("lines") == 1, F.col("lines") > 1
    return rows.select(
        "order_item_id", "order_id", F.col("product_id").alias("magento_product_id"),
        F.when(single, F.col("u_cost")).alias("cost_unique"),
        F.when(single, F.col("u_weighted")).alias("averageweightedcost_unique"),
        F.when(several, F.col("p_cost")).alias("cost_duplicate"),
        F.when(several, F.col("p_weighted")).alias("averageweightedcost_duplicate"),
        F.when(several & (F.col("row_total") != 0), F.col("a_cost")).alias("cost_avg"),
        F.when(several & (F.col("row_total") != 0), F.col("a_weighted")).alias("averageweightedcost_avg"),
    )


def order_cost(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Item costs with the totals of their order."""
    costed = t["int_item_costs"]
    per_order = costed.groupBy("order_id").agg(
        F.sum(F.coalesce("cost_unique", "cost_duplicate")).alias("order_cost"),
        F.sum(F.coalesce("averageweightedcost_unique", "averageweightedcost_duplicate")).alias("order_cost_average"),
    )
    return costed.join(per_order, "order_id", "left")


def item_cost(quantity: str) -> Column:
    """First known cost of an item, weighted costs times quantity last."""
    return F.coalesce(
        "cost_unique", "cost_duplicate", "cost_avg",
        F.col("averageweightedcost_unique") * F.col(quantity),
        F.col("averageweightedcost_duplicate") * F.col(quantity),
        F.col("averageweightedcost_avg") * F.col(quantity),
    )


def net_row_total() -> Column:
    zero = F.lit(0)
    return (
        F.col("row_total") - F.coalesce("amount_refunded", zero)
        - F.coalesce("discount_amount", zero) + F.coalesce("discount_refunded", zero)
    )


def cost_fallback(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Unit cost of a product on the newest time at which a cost was known."""
    costs = t["int_item_costs"].drop("order_id", "magento_product_id")
    rows = t["magento_sales_order_item"].join(costs, "order_item_id", "left").select(
        "order_item_id", "product_id", "product_type", "parent_item_id",
        wall_clock("item_created_at", cfg.timezone).alias("sold_at"),
        F.when(net_row_total() == 0, 0).otherwise(F.col("quantity_ordered")).alias("qty"),
        F.when(F.col("quantity_ordered") > 0, item_cost("quantity_ordered")).alias("cost"),
    )
    resolved = inherit_from_parent(
        rows, "order_item_id", "parent_item_id", F.col("product_type") == "configurable", ["cost", "qty"]
    ).filter((F.col("cost") > 0) & (F.col("qty") > 0)).select("product_id", "sold_at", "cost", "qty")
    # Rows of one product and time are summed first; picking the newest of those
    # sums needs no join back to the lines.
    per_time = resolved.groupBy("product_id", "sold_at").agg(F.sum("cost").alias("cost"), F.sum("qty").alias("qty"))
    return per_time.groupBy("product_id").agg(
        F.max_by(safe_div("cost", "qty"), F.col("sold_at")).alias("fallback_unit_cost")
    )


def shipment_costs(t: Tables, keys: tuple[str, ...], own_amount: str) -> DataFrame:
    """Freight per shipment group: carrier invoices first, own figures otherwise."""
    invoiced = t["magento_ups_invoice"].groupBy("tracking_number").agg(F.sum("net_amount").alias("net_amount"))
    cartons = t["fishbowl_shipcarton"].select("shipment_id", "tracking_number", "freight_amount", "freight_weight")
    ships = t["fishbowl_ship"].select("shipment_id", "sales_order_id", "carrier_service_id")
    # Cartons without a tracking number are dealt out by shipment and match nothing.
    known = F.col("tracking_number").isNotNull()
    dealt = F.coalesce("tracking_number", F.concat(F.lit("-"), F.col("shipment_id").cast("string"))) == F.col("__invoiced")
    return (
        ships.join(cartons, "shipment_id", "left")
        .join(invoiced.withColumnRenamed("tracking_number", "__invoiced"), dealt & known, "left")
        .groupBy(*keys).agg(
            F.coalesce(F.sum("net_amount"), F.sum(own_amount)).alias("freight_amount"),
            F.sum("freight_weight").alias("freight_weight"),
            F.avg("carrier_service_id").alias("carrier_service_id"),
            F.sum("net_amount").alias("net_amount"),
            F.count("tracking_number").alias("package_count"),
        )
    )


def order_shipments(t: Tables) -> DataFrame:
    """Freight per ERP order: the table of that name, which several models share, or built on the spot."""
    return t["int_order_shipments"] if "int_order_shipments" in set(t) else shipment_costs(t, ("sales_order_id",), "freight_amount")


def order_freight(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Shipping revenue and cost, weight and item count per shop order."""
    shipped = order_shipments(t).withColumnRenamed("sales_order_id", "fishbowl_so_id")
    per_shop_order = (
        t["int_fishbowl_magento_order_map"].join(shipped, "fishbowl_so_id", "left")
        .groupBy(F.col("magento_order_id").alias("order_id")).agg(F.avg("freight_amount").alias("freight_amount"))
    )
    skus = t["magento_catalog_product_entity"].select(
        F.col("product_entity_id").alias("product_id"), F.col("sku").alias("catalog_sku")
    )
    weights = (
        t["magento_sales_order_item"].filter((net_row_total() != 0) & (F.col("quantity_ordered") != 0))
        .select("order_id", "product_id", "item_weight")
        .join(skus.filter(~F.col("catalog_sku").ilike(cfg.unweighted_sku_pattern)), "product_id")
        .groupBy("order_id").agg(F.sum("item_weight").alias("total_weight"), F.count("product_id").alias("product_count"))
    )
    amounts = ("shipping_amount", "base_shipping_amount", "base_shipping_canceled", "base_shipping_discount_amount",
               "base_shipping_refunded", "base_shipping_tax_amount", "base_shipping_tax_refunded")
    zero = F.lit(0)
    net = (
        F.coalesce("base_shipping_amount", zero) - F.coalesce("base_shipping_tax_amount", zero)
        - F.coalesce("base_shipping_refunded", zero) + F.coalesce("base_shipping_tax_refunded", zero)
    )
    shipping = t["magento_sales_order"].join(per_shop_order, "order_id", "left").groupBy("order_id").agg(
        *[F.sum(a).alias(a) for a in amounts], F.sum(net).alias("net_sales"), F.sum("freight_amount").alias("freight_amount"),
    )
    return shipping.join(weights, "order_id", "left")


def product_conversion(t: Tables, cfg: RetailConfig = DEFAULT, reference_key: bool = False) -> DataFrame:
    """Pieces sold per item.

    The unit of the ERP product decides the conversion. `reference_key=True` matches
    the conversion on the shop product id instead, for parity with existing numbers.
    """
    orders = t["magento_sales_order"].select("order_id")
    catalog = t["magento_catalog_product_entity"].select(F.col("product_entity_id").alias("product_id"), "sku")
    parts = t["fishbowl_part"].select("part_id")
    erp = t["fishbowl_product"].select(F.col("product_number").alias("sku"), "part_id", "uom_id").join(parts, "part_id", "left_semi")
    to_base = t["fishbowl_uomconversion"].filter(F.col("to_uom_id") == cfg.base_uom_id).select(
        F.col("from_uom_id").cast("bigint").alias("conversion_key"), "multiply_factor"
    )
    multiply = F.coalesce("multiply_factor", F.lit(1))
    # The pieces of a product are settled before the items come in.
    per_product = (
        catalog.join(erp, "sku").withColumn("conversion_key", F.col("product_id" if reference_key else "uom_id").cast("bigint"))
        .join(to_base, "conversion_key", "left")
        .groupBy("product_id", "sku").agg(F.sum(multiply).alias("pieces"), F.count(F.lit(1)).alias("matches"))
    )
    return (
        t["magento_sales_order_item"].filter((F.col("product_type") != "bundle") & (F.col("row_total") != 0))
        .select(F.col("order_item_id").alias("item_id"), "order_id", "product_id", "quantity_ordered")
        .join(orders, "order_id", "left_semi").join(per_product, "product_id")
        .groupBy("item_id", "sku").agg(
            F.sum(F.col("quantity_ordered") * F.col("pieces")).alias("part_qty_sold"),
            (F.sum("pieces") / F.sum("matches")).alias("conversion"),
        )
    )


def builders(cfg: RetailConfig = DEFAULT) -> dict:
    return {
        "int_fishbowl_magento_order_map": order_map,
        "int_item_costs": lambda t: item_costs(t, cfg),
        "int_fishbowl_order_cost": lambda t: order_cost(t, cfg),
        "int_sales_cost_fallback": lambda t: cost_fallback(t, cfg),
        "int_order_shipments": lambda t: shipment_costs(t, ("sales_order_id",), "freight_amount"),
        "int_magento_order_freight": lambda t: order_freight(t, cfg),
        "int_magento_product_conversion": lambda t: product_conversion(t, cfg),
    }
