"""The whole model graph: landing tables in, named tables out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.operators.history import segment_snapshot
from stocktally.plans import costs, customers, inventory, products, purchasing, sales
from stocktally.plans.quality import Expectation, Finding
from stocktally.sources import silver
from stocktally.sources.sinks import archive_then_overwrite, checked_commit, current, gathered, merge_by_key, read_merged, read_table, replace_table, table_exists, write_bucketed
from stocktally.sources.tables import Tables

# Read by many models: written once, so later reads scan files instead of
# repeating the clean-up and its shuffle.
SHARED = (
    "fishbowl_soitem", "fishbowl_product", "fishbowl_uomconversion", "fishbowl_part", "magento_sales_order_item",
    "magento_sales_order", "magento_catalog_product_entity_int", "magento_catalog_product_entity_varchar",
    "magento_catalog_product_entity_text", "magento_d_customerupdated", "inventory_qtyinventory", "int_item_costs",
    "int_order_shipments", "int_magento_order_freight", "int_magento_product_eav_lookups", "int_sales_cost_fallback", "int_shop_items",
    "int_receipt_lines", "d_product", "f_sales", "f_pos",
)


def gold_builders(cfg: RetailConfig = DEFAULT, as_of: str | None = None) -> dict:
    """Builders of all inventory and gold tables."""
    return {
        **inventory.builders(cfg), **products.builders(cfg), **costs.builders(cfg), **sales.builders(cfg),
        **purchasing.builders(cfg), **customers.builders(cfg, as_of),
    }


def model(landing: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame], cfg: RetailConfig = DEFAULT, as_of: str | None = None) -> Tables:
    """All tables of the model over a set of landing tables."""
    return Tables({**silver.builders(landing, cfg), **gold_builders(cfg, as_of)}, dict(seeds))


def materialize(tables: Tables, root: str, names: Sequence[str] = SHARED, checks: Mapping[str, Sequence[Expectation]] | None = None) -> None:
    """Commit tables in order and read later uses back from the files. A broken check of severity error stops the run."""
    for name in names:
        if name in set(tables):
            frame = tables[name]
            path = f"{root}/{name}"
            replace_table(frame.sparkSession, frame, path, checks=(checks or {}).get(name, ()))
            tables.put(name, read_table(frame.sparkSession, path))


# Keys by which readers join the stored models.
LAYOUT = {
    "f_sales": ("order_id",), "int_shop_items": ("order_id",), "int_item_costs": ("order_id",), "int_magento_order_freight": ("order_id",),
    "d_product": ("product_id",), "int_sales_cost_fallback": ("product_id",), "int_magento_product_eav_lookups": ("entity_id",),
    "inventory_qtyinventory": ("part_id",), "f_pos": ("part_id",), "int_receipt_lines": ("part_id",),
}


def lay_out(tables: Tables, buckets: int, names: Sequence[str] = tuple(LAYOUT), prefix: str = "", root: str | None = None) -> None:
    """Store models as catalog tables bucketed by their join keys and read later uses from these.

    The number of buckets is the same for all, so that f_sales meets its order facts without an exchange; choose it so
    that a bucket of the largest table is some hundred MB.
    """
    for name in names:
        if name in set(tables):
            path = f"{root}/{name}" if root else None
            tables.put(name, write_bucketed(tables[name], prefix + name, LAYOUT[name], buckets, path))


def sales_by_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sold_month", F.date_format("created_at", "yyyy-MM"))


def refresh(
    tables: Tables, root: str, as_of: str, cfg: RetailConfig = DEFAULT, full: bool = False, forecasts: Mapping[str, DataFrame] | None = None,
    checks: Sequence[Expectation] = (),
) -> list[Finding]:
    """One run of the pipeline into a folder; every table is committed as a whole, so that readers never see half of one.

    f_sales is written whole the first time (or when `full`), by month; later runs merge
    the rows of recently touched orders. segment_history gets a snapshot. Each forecast,
    named by its type, replaces the one of that type in f_forecast after that has gone to
    f_forecast_history. A run that stopped can be repeated with the same as_of.

    `checks` are counted on the rows of f_sales by the job that writes them; a broken one of severity error raises
    before the commit, all others are returned.
    """
    spark = tables["f_sales"].sparkSession
    stored, segments = f"{root}/f_sales", f"{root}/segment_history"
    if full or not table_exists(spark, stored):
        findings = replace_table(spark, gathered(sales_by_month(tables["f_sales"]), "sold_month"), stored, "sold_month", checks)
    else:
        findings = merge_by_key(spark, stored, sales_by_month(sales.sales_increment(tables, as_of, cfg)), ["id"], "sold_month", checks)
    if "d_customer_segmentation" in set(tables):
        before = current(spark, segments)
        history = read_table(spark, segments) if table_exists(spark, segments) else None
        taken = history is not None and not history.filter(F.col("valid_from") == F.lit(as_of).cast("timestamp")).isEmpty()
        if not taken:
            checked_commit(spark, segments, segment_snapshot(tables["d_customer_segmentation"], history, as_of), before)
    for kind, rows in (forecasts or {}).items():
        archive_then_overwrite(spark, f"{root}/f_forecast", f"{root}/f_forecast_history", rows, "forecast_type", kind, as_of)
    return findings


def stored_sales(tables: Tables, root: str) -> DataFrame:
    """f_sales as refresh has stored it."""
    like = sales_by_month(tables["f_sales"])
    return read_merged(like.sparkSession, f"{root}/f_sales", like, "sold_month").drop("sold_month")
