"""Named metrics over the star schema, and the standing business questions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.functions.scalars import pct, safe_div
from stocktally.operators.ordering import top_rows
from stocktally.sources.tables import Tables


@dataclass(frozen=True)
class Subject:
    """A fact or dimension table with its measures and the tables it links to."""

    table: str
    metrics: dict[str, Callable[[], Column]]
    filters: dict[str, Callable[[], Column]] = field(default_factory=dict)


def _s(c: str) -> Column:
    return F.sum(c)


SUBJECTS: dict[str, Subject] = {
    "sales": Subject("f_sales", {
        "total_revenue": lambda: _s("row_total"), "total_orders": lambda: F.count_distinct("order_id"),
        "gross_profit": lambda: _s("row_total") - _s("cost"),
        "gross_margin": lambda: safe_div(_s("row_total") - _s("cost"), _s("row_total")),
        "aov": lambda: safe_div(_s("row_total"), F.count_distinct("order_id")), "total_units": lambda: _s("qty_ordered"),
        "gp_after_variable_cost": lambda: _s("row_total") - _s("cost") - _s("freight_cost"),
        "shipping_pct": lambda: pct(_s("freight_revenue"), _s("row_total")),
    }, {"standard_statuses": lambda: F.col("status").isin("COMPLETE", "PROCESSING", "UNVERIFIED")}),
    "inventory": Subject("f_inventoryview", {
        "total_on_hand": lambda: _s("qty_available"), "total_inventory_value": lambda: _s("extended_cost"),
        "total_on_order": lambda: _s("qty_on_order"),
    }),
    "purchase_orders": Subject("f_pos", {
        "avg_lead_time": lambda: F.avg("precise_leadtime"), "total_po_cost": lambda: _s("total_cost"),
        "total_qty_received": lambda: _s("qty"),
    }, {"open_pos": lambda: F.col("datereceived").isNull() & (F.col("quantity_to_fulfill") > 0)}),
    "customer_segments": Subject("d_customer_segmentation", {
        "customer_count": lambda: F.count_distinct("rank_id"), "avg_customer_revenue": lambda: F.avg("total_revenue"),
    }),
    "products": Subject("int_product_analyst", {}), "vendors": Subject("d_vendor", {}),
}

# (left subject, right subject): left key, right key
RELATIONSHIPS = {
    ("sales", "products"): ("product_id", "product_id"), ("sales", "vendors"): ("vendor", "vendor_id"),
    ("sales", "customer_segments"): ("rank_id", "rank_id"), ("purchase_orders", "vendors"): ("vendor_id", "vendor_id"),
}


def metric(
    t: Tables, subject: str, names: Sequence[str], by: Sequence[str] = (), where: Sequence[str | Column] = (),
    join: str | None = None,
) -> DataFrame:
    """Metrics of a subject, grouped by its own or a related subject's columns."""
    spec = SUBJECTS[subject]
    rows = t[spec.table]
    for condition in where:
        rows = rows.filter(spec.filters[condition]() if isinstance(condition, str) else condition)
    if join is not None:
        left, right = RELATIONSHIPS[(subject, join)]
        other = t[SUBJECTS[join].table]
        wanted = [c for c in by if c in other.columns and c not in rows.columns]
        side = other.select(F.col(right).alias("__key"), *wanted)
        rows = rows.join(side, F.col(left) == F.col("__key"), "left").drop("__key")
    return rows.groupBy(*by).agg(*[spec.metrics[n]().alias(n) for n in names])


# --- standing questions --------------------------------------------------------
class Questions:
    """The verified business questions; every one is relative to an as-of date."""

    def __init__(self, t: Tables, as_of: str, cfg: RetailConfig = DEFAULT):
        self.t, self.cfg = t, cfg
        self.today = F.lit(as_of).cast("date")
        self.day = F.col("created_at").cast("date")

    def _sales(self, when: Column) -> DataFrame:
        return self.t["f_sales"].filter(when & SUBJECTS["sales"].filters["standard_statuses"]())

    def _on_day(self, offset: int = 0) -> DataFrame:
        return self._sales(self.day == F.date_add(self.today, offset))

    def _in_month(self) -> DataFrame:
        return self._sales(F.trunc("created_at", "month") == F.trunc(self.today, "month"))

    def _with_products(self, rows: DataFrame, *columns: str) -> DataFrame:
        return rows.join(self.t["d_product"].select("product_id", *columns), "product_id")

    def _stock(self, *columns: str) -> DataFrame:
        products = self.t["int_product_analyst"].select("sku", *columns)
        return self.t["f_inventoryview"].join(products, F.col("part_number") == F.col("sku"))

    def revenue_today(self) -> DataFrame:
        return self._on_day().agg(_s("row_total").alias("total_revenue"))

    def gross_margin_this_month(self) -> DataFrame:
        return self._in_month().agg(pct(_s("row_total") - _s("cost"), _s("row_total")).alias("gross_margin_pct"))

    def top_products_this_week(self, n: int = 10) -> DataFrame:
        rows = self._with_products(self._sales(self.day >= F.trunc(self.today, "week")), "product_name", "sku")
        out = rows.groupBy("product_name", "sku").agg(_s("row_total").alias("revenue"))
        return top_rows(out, [F.col("revenue").desc_nulls_last(), F.col("sku")], n)

    def orders_last_two_days(self) -> DataFrame:
        rows = self._sales(self.day.between(F.date_sub(self.today, 2), F.date_sub(self.today, 1)))
        return rows.groupBy(self.day.alias("order_date")).agg(F.count_distinct("order_id").alias("total_orders"))

    def revenue_by_category(self) -> DataFrame:
        return self._with_products(self._in_month(), "primary_category").groupBy(F.col("primary_category").alias("category")).agg(
            _s("row_total").alias("revenue"))

    def top_manufacturers_by_units(self, n: int = 5) -> DataFrame:
        rows = self._with_products(self._in_month(), "manufacturer_sku")
        out = rows.groupBy(F.col("manufacturer_sku").alias("manufacturer")).agg(_s("qty_ordered").alias("units_sold"))
        return top_rows(out, [F.col("units_sold").desc_nulls_last(), F.col("manufacturer")], n)

    def units_in_stock_like(self, pattern: str) -> DataFrame:
        return self._stock("caliber").filter(F.col("caliber").ilike(pattern)).agg(_s("qty_available").alias("units_in_stock"))

    def units_in_stock_by_caliber(self, n: int = 20) -> DataFrame:
        out = self._stock("caliber").filter(F.col("caliber").isNotNull()).groupBy("caliber").agg(
            _s("qty_available").alias("units_in_stock"), _s("extended_cost").alias("inventory_value"))
        return top_rows(out, [F.col("units_in_stock").desc_nulls_last(), F.col("caliber")], n)

    def slowest_vendors(self, n: int = 10, minimum: int = 5) -> DataFrame:
        named = self.t["f_pos"].filter(F.col("precise_leadtime").isNotNull()).join(self.t["d_vendor"].select("vendor_id", "vendor_name"), "vendor_id")
        out = named.groupBy("vendor_name").agg(
            F.round(F.avg("precise_leadtime"), 1).alias("avg_lead_time_days"), F.count(F.lit(1)).alias("receipt_count")
        ).filter(F.col("receipt_count") >= minimum)
        return top_rows(out, [F.col("avg_lead_time_days").desc_nulls_last(), F.col("vendor_name")], n)

    def open_purchase_orders(self, n: int = 50) -> DataFrame:
        rows = self.t["f_pos"].filter(SUBJECTS["purchase_orders"].filters["open_pos"]())
        products = self.t["d_product"].select(F.col("sku").alias("part_number"), "sku", "product_name")
        out = rows.join(self.t["d_vendor"].select("vendor_id", "vendor_name"), "vendor_id").join(products, "part_number")
        out = out.select(
            F.col("purchase_order_id").alias("po_id"), "vendor_name", "sku", "product_name",
            F.col("quantity_to_fulfill").alias("qty_pending"), "unit_cost", F.col("po_created_at").cast("date").alias("po_date"),
            "po_created_at", "receipt_item_id",
        )
        return top_rows(out, [F.col("po_created_at").desc_nulls_last(), F.col("receipt_item_id")], n).drop("po_created_at", "receipt_item_id")

    def segment_size(self, name: str = "At-Risk Regular") -> DataFrame:
        rows = self.t["d_customer_segmentation"].filter(F.col("customer_classification") == name)
        return rows.agg(F.count_distinct("rank_id").alias("customer_count"))

    def gp_after_variable_cost_today(self) -> DataFrame:
        after = _s("row_total") - _s("cost") - _s("freight_cost")
        return self._on_day().agg(F.round(after, 2).alias("gp_after_variable_cost"), pct(after, _s("row_total")).alias("contribution_margin_pct"))

    def shipping_share_today(self) -> DataFrame:
        return self._on_day().agg(pct(_s("freight_revenue"), _s("row_total")).alias("shipping_revenue_pct"))

    def sales_by_hour_today(self) -> DataFrame:
        return self._on_day().groupBy(F.hour("timedate").alias("hour_of_day")).agg(
            _s("row_total").alias("revenue"), F.count_distinct("order_id").alias("orders"))

    def _two_periods(self, start: Column, prior_start: Column, prior_end: Column, names: tuple[str, str]) -> DataFrame:
        """Revenue of the running period and of the same stretch before, in one scan."""
        now, then = self.day.between(start, self.today), self.day.between(prior_start, prior_end)
        sums = self._sales(now | then).agg(_s_if(now).alias("now"), _s_if(then).alias("then"))
        pair = F.array(*[F.struct(F.lit(n).alias("period"), F.col(c).alias("revenue")) for n, c in zip(names, ("now", "then"))])
        return sums.select(F.explode(pair).alias("p")).select("p.*")

    def revenue_mtd_vs_prior(self) -> DataFrame:
        before = F.add_months(self.today, -1)
        return self._two_periods(F.trunc(self.today, "month"), F.trunc(before, "month"), before, ("Current MTD", "Prior Month MTD"))

    def revenue_ytd_vs_prior(self) -> DataFrame:
        before = F.add_months(self.today, -12)
        return self._two_periods(F.trunc(self.today, "year"), F.trunc(before, "year"), before, ("Current YTD", "Prior Year YTD"))

    def daily_revenue_30_days(self) -> DataFrame:
        return self._sales(self.day >= F.date_sub(self.today, 30)).groupBy(self.day.alias("sale_date")).agg(
            _s("row_total").alias("revenue"), F.count_distinct("order_id").alias("orders"))

    def revenue_by_caliber(self) -> DataFrame:
        return self._with_products(self._in_month(), "caliber").groupBy("caliber").agg(
            _s("row_total").alias("revenue"), _s("qty_ordered").alias("units_sold"))

    def margin_by_manufacturer(self, n: int = 20) -> DataFrame:
        rows = self._with_products(self._in_month(), "manufacturer_sku")
        out = rows.groupBy(F.col("manufacturer_sku").alias("manufacturer")).agg(
            _s("row_total").alias("revenue"), _s("cost").alias("total_cost"),
            pct(_s("row_total") - _s("cost"), _s("row_total")).alias("margin_pct"),
        ).filter(F.col("revenue") > 0)
        return top_rows(out, [F.col("revenue").desc_nulls_last(), F.col("manufacturer")], n)

    def revenue_by_storefront(self) -> DataFrame:
        orders = F.count_distinct("order_id")
        return self._in_month().groupBy("storefront").agg(
            _s("row_total").alias("revenue"), orders.alias("orders"), F.round(safe_div(_s("row_total"), orders), 2).alias("aov"))

    def top_states(self, n: int = 15) -> DataFrame:
        rows = self._in_month().filter(F.col("region").isNotNull())
        out = rows.groupBy(F.col("region").alias("state")).agg(_s("row_total").alias("revenue"), F.count_distinct("order_id").alias("orders"))
        return top_rows(out, [F.col("revenue").desc_nulls_last(), F.col("state")], n)

    def aov_by_store(self) -> DataFrame:
        orders = F.count_distinct("order_id")
        by_store = self._in_month().groupBy("store_id").agg(
            F.round(safe_div(_s("row_total"), orders), 2).alias("aov"), orders.alias("orders"))
        stores = self.t["d_store"].select("store_id", F.col("name").alias("store_name"))
        return by_store.join(stores, "store_id", "left")

    def inventory_value(self) -> DataFrame:
        return self.t["f_inventoryview"].agg(_s("qty_available").alias("total_units"), _s("extended_cost").alias("total_value"))

    def segment_distribution(self) -> DataFrame:
        return self.t["d_customer_segmentation"].groupBy(F.col("customer_classification").alias("segment")).agg(
            F.count_distinct("rank_id").alias("customer_count"), F.round(F.avg("total_revenue"), 2).alias("avg_revenue"),
            F.round(F.avg("days_since_last_purchase"), 0).alias("avg_days_since_last"))


def _s_if(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("row_total")))
