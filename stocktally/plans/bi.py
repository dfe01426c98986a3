"""Dashboard analytics. Everything aggregates in Spark; only final rows leave it."""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.functions.scalars import hour_label, pct_delta, safe_div, zip3_number, zip_state
from stocktally.operators.aggregates import with_total_row
from stocktally.operators.ordering import priority, top_rows
from stocktally.sources.tables import Tables


# --- periods ----------------------------------------------------------------
@dataclass(frozen=True)
class Period:
    start: date
    end: date
    compare_start: date
    compare_end: date

    @property
    def days(self) -> int:
        return max((self.end - self.start).days + 1, 1)


def period(kind: str, as_of: str, year: int | None = None, month: int | None = None) -> Period:
    """TODAY, MTD, YTD or CUSTOM (year, optional month) with its comparison span."""
    today = date.fromisoformat(as_of)
    if kind == "TODAY":
        before = today - timedelta(days=1)
        return Period(today, today, before, before)
    if kind == "MTD":
        first = today.replace(day=1)
        last = first - timedelta(days=1)
        return Period(first, today, last.replace(day=1), last.replace(day=min(today.day, last.day)))
    if kind == "YTD":
        leap = today.month == 2 and today.day == 29
        return Period(today.replace(month=1, day=1), today, date(today.year - 1, 1, 1),
                      date(today.year - 1, today.month, 28 if leap else today.day))
    if kind == "CUSTOM":
        first, last = (1, 12) if month is None else (month, month)
        start = date(year, first, 1)
        end = min(date(year, last, calendar.monthrange(year, last)[1]), today)
        return Period(start, end, date(year - 1, start.month, start.day), date(year - 1, end.month, min(end.day, 28)))
    raise ValueError(f"unknown period {kind!r}")


def between(day: str, start: date, end: date) -> Column:
    return F.col(day).cast("date").between(F.lit(start), F.lit(end))


# --- fact -------------------------------------------------------------------
def sales_facts(t: Tables, start: str, end: str, statuses: Sequence[str] | None = None, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Sales with product attributes for a date span; states are filled from postcodes."""
    wanted = list(statuses or cfg.valid_order_statuses)
    rows = t["f_sales"].filter(between("created_at", date.fromisoformat(start), date.fromisoformat(end)) & F.col("status").isin(wanted))
    products = t["d_product"].select(
        "product_id", F.col("vendor").alias("product_vendor"), F.col("attribute_set").alias("category"), "manufacturer",
        F.coalesce("dd_caliber", "caliber").alias("caliber"), "projectile", "general_purpose", "manufacturer_sku",
        "product_name", "primary_category", "use_type_category",
    )
    return rows.select(
        "created_at", "timedate", F.hour("timedate").alias("hour_num"), F.col("increment_id").alias("order_id"),
        "customer_email", "customer_name", "store_id", "storefront", "status", F.col("row_total").alias("net_sales"), "cost",
        "qty_ordered", "freight_revenue", "freight_cost", "product_id", F.col("testsku").alias("sku"),
        F.round(F.coalesce("part_qty_sold", "qty_ordered")).cast("int").alias("units"),
        F.coalesce("region", zip_state("postcode")).alias("region"), "city", "postcode",
    ).join(products, "product_id", "left")


# --- measures ---------------------------------------------------------------
def measures(net: str = "net_sales", cost: str = "cost", order: str = "order_id", units: str = "units") -> dict[str, Column]:
    return {
        "net_sales": F.sum(net), "cost": F.sum(cost), "gp": F.sum(net) - F.sum(cost),
        "orders": F.count_distinct(order), "units": F.sum(units),
    }


def metric_value(metric: str, net: str = "net_sales", cost: str = "cost", order: str = "order_id", units: str = "units") -> Column:
    """Dashboard metric by its switch label."""
    m = measures(net, cost, order, units)
    return {"$": m["net_sales"], "GP ($)": m["gp"], "Orders": m["orders"], "Units": m["units"]}[metric]


def kpis(rows: DataFrame, cfg: RetailConfig = DEFAULT, by: Sequence[str] = ()) -> DataFrame:
    """Headline numbers. Lines are summed per order first, which also gives the
    orders above the free-shipping threshold."""
    per_order = rows.groupBy(*by, "order_id").agg(
        *[F.sum(c).alias(c) for c in ("net_sales", "cost", "units", "freight_revenue", "freight_cost")]
    )
    known = F.col("order_id").isNotNull()
    total = per_order.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("net_sales", "cost", "units", "freight_revenue", "freight_cost")],
        F.count_if(known).alias("orders"),
        F.count_if(known & (F.col("net_sales") >= cfg.free_shipping_threshold)).alias("free_ship_orders"),
    )
    gross = F.col("net_sales") - F.col("cost")
    after = gross - F.col("freight_cost")
    return total.select(
        *by, "net_sales", "cost", gross.alias("gross_profit"), "orders", "units", F.col("freight_revenue").alias("freight_rev"),
        "freight_cost", after.alias("gp_after_var"), "free_ship_orders",
        (safe_div(gross, "net_sales") * 100).alias("margin"), safe_div("net_sales", "orders").alias("avg_ticket"),
        (safe_div("freight_revenue", "net_sales") * 100).alias("shipping_pct"),
        (safe_div(after, "net_sales") * 100).alias("contribution_margin"),
    )


def compare_periods(rows: DataFrame, span: Period, day: str = "created_at", cfg: RetailConfig = DEFAULT) -> DataFrame:
    """KPIs of a span and of its comparison span side by side, with percent change.

    One scan: a row is labelled with its span and both are aggregated together.
    """
    label = F.when(between(day, span.start, span.end), "current").when(between(day, span.compare_start, span.compare_end), "previous")
    both = kpis(rows.withColumn("period", label).filter(F.col("period").isNotNull()), cfg, ["period"])
    names = [c for c in both.columns if c != "period"]
    # Two rows at most become one; a span without sales counts as zero.
    side = lambda name, c: F.max(F.when(F.col("period") == name, F.col(c).cast("double"))).alias(f"{name}_{c}")
    paired = both.agg(*[side(name, c) for name in ("current", "previous") for c in names]).fillna(0.0)
    long = F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col("current_" + c).alias("current"), F.col("previous_" + c).alias("previous")) for c in names
    ]))
    return paired.select(long.alias("m")).select("m.*").withColumn("pct_change", pct_delta("current", "previous"))


def hourly_profile(rows: DataFrame, metric: str) -> DataFrame:
    """One value per hour of the day."""
    return rows.groupBy(F.col("hour_num").alias("hour")).agg(metric_value(metric).alias("value")).withColumn("hour_label", hour_label("hour"))


def hourly_average(rows: DataFrame, metric: str, day: str = "created_at") -> DataFrame:
    """Mean over days of the hourly values."""
    daily = rows.groupBy(day, F.col("hour_num").alias("hour")).agg(metric_value(metric).alias("v"))
    return daily.groupBy("hour").agg(F.avg("v").alias("value")).withColumn("hour_label", hour_label("hour"))


def daily_trend(rows: DataFrame, day: str = "created_at") -> DataFrame:
    m = measures()
    out = rows.groupBy(F.col(day).alias("day")).agg(*[c.alias(n) for n, c in m.items()])
    return out.withColumn("margin", F.coalesce(safe_div("gp", "net_sales") * 100, F.lit(0)))


def weekday_heatmap(rows: DataFrame, metric: str, day: str = "created_at") -> DataFrame:
    """Weekday rows by 24 hour columns; empty cells are zero.

    The hours are given, so the pivot needs no extra pass to find its columns.
    """
    keys = [F.weekday(day).alias("dow_num"), F.date_format(day, "EEEE").alias("dow")]
    cells = rows.groupBy(*keys, "hour_num").agg(metric_value(metric).alias("v"))
    wide = cells.groupBy("dow_num", "dow").pivot("hour_num", list(range(24))).agg(F.sum("v"))
    return wide.select("dow_num", "dow", *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h:02d}") for h in range(24)])


def top_by(rows: DataFrame, dimension: str, metric: str, n: int = 8) -> DataFrame:
    """Leaders of a dimension; missing members are named."""
    label = F.coalesce(F.col(dimension), F.lit("(Blank)"))
    ranked = rows.groupBy(label.alias(dimension)).agg(metric_value(metric).alias("value"))
    return top_rows(ranked, [F.col("value").desc_nulls_last(), F.col(dimension)], n)


def _product_block(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    m = measures()
    out = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in m.items()], F.sum("freight_revenue").alias("s_rev"))
    return out.withColumns({
        "margin": F.coalesce(safe_div("gp", "net_sales") * 100, F.lit(0)), "per_unit": F.coalesce(safe_div("net_sales", "units"), F.lit(0)),
    })


def sku_performance(rows: DataFrame, compare: DataFrame | None = None, n: int = 25) -> tuple[DataFrame, DataFrame]:
    """Top SKUs and their product detail, each with the comparison period's sales."""
    names = {"manufacturer_sku": F.coalesce("manufacturer_sku", F.lit("(No SKU)")), "product_name": F.coalesce("product_name", F.lit("(No Name)"))}
    rows = rows.withColumns(names)
    top = top_rows(_product_block(rows, ["manufacturer_sku"]), [F.col("net_sales").desc_nulls_last(), F.col("manufacturer_sku")], n)
    # The leader list is at most n rows.
    detail = _product_block(
        rows.join(F.broadcast(top.select("manufacturer_sku")), "manufacturer_sku", "left_semi"), ["manufacturer_sku", "product_name"]
    )
    if compare is not None:
        before = compare.withColumns(names)
        for_sku = before.groupBy("manufacturer_sku").agg(F.sum("net_sales").alias("net_sales_compare"))
        for_product = before.groupBy("manufacturer_sku", "product_name").agg(F.sum("net_sales").alias("net_sales_compare"))
        top = top.join(for_sku, "manufacturer_sku", "left").withColumn("pct_change", pct_delta("net_sales", "net_sales_compare"))
        detail = detail.join(for_product, ["manufacturer_sku", "product_name"], "left").withColumn("pct_change", pct_delta("net_sales", "net_sales_compare"))
    return top, detail


def by_city(rows: DataFrame) -> DataFrame:
    """Sales per city with a total row; orders and units add up over cities."""
    m = measures()
    cities = rows.filter(F.col("city").isNotNull()).groupBy("city").agg(*[c.alias(n) for n, c in m.items()])
    cities = cities.withColumn("margin", F.round(F.coalesce(safe_div("gp", "net_sales") * 100, F.lit(0)), 2))
    sums = [F.sum(c).alias(c) for c in ("net_sales", "cost", "gp", "orders", "units")]
    return with_total_row(cities, "city", "Total", [*sums, F.round(safe_div(F.sum("gp"), F.sum("net_sales")) * 100, 2).alias("margin")])


def by_state(rows: DataFrame, region: str = "region", postcode: str = "postcode") -> DataFrame:
    m = measures()
    state = F.coalesce(F.col(region), zip_state(postcode))
    return rows.groupBy(state.alias("state")).agg(*[c.alias(n) for n, c in m.items()])


def by_zip3(rows: DataFrame, centroids: DataFrame) -> DataFrame:
    """Sales per postcode area with coordinates; areas without coordinates drop out.

    centroids has zip3 (three characters), lat, lon.
    """
    placed = rows.withColumn("zip3", F.substring("postcode", 1, 3)).groupBy("postcode", "zip3", "city", "region").agg(
        F.sum("net_sales").alias("net_sales"), F.count_distinct("order_id").alias("orders")
    )
    return placed.join(centroids, "zip3")


def top_customers(rows: DataFrame, n: int = 25) -> tuple[DataFrame, DataFrame]:
    """Best customers and their orders."""
    m = measures()
    named = rows.filter(F.col("customer_email").isNotNull() & F.col("customer_name").isNotNull())
    top = top_rows(
        named.groupBy("customer_email", "customer_name").agg(*[c.alias(k) for k, c in m.items()]),
        [F.col("net_sales").desc_nulls_last(), F.col("customer_email")], n,
    )
    mine = rows.join(F.broadcast(top.select("customer_email").distinct()), "customer_email", "left_semi")
    orders = mine.groupBy("customer_email", "order_id").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("cost").alias("cost"), F.sum("units").alias("units"),
        (F.sum("net_sales") - F.sum("cost")).alias("gp"),
    )
    return top, orders


# --- inventory --------------------------------------------------------------
def days_of_supply(stock: DataFrame, sold: DataFrame, n_days: int, key: str = "sku") -> DataFrame:
    """Stock against the daily sales of a period.

    stock(key, qty_available, qty_on_order, part_cost, extended_cost) and
    sold(key, units_sold, net_sales, cost_of_goods).
    """
    rows = stock.join(sold, key, "left").fillna(0, ["units_sold", "net_sales", "cost_of_goods"])
    daily = F.col("units_sold") / n_days
    whole = stock.agg(F.sum("qty_available").alias("__all"))
    rows = rows.join(F.broadcast(whole), F.lit(True), "left")  # one row
    return rows.withColumns({
        "daily_avg": daily,
        "days_of_supply": F.when(daily > 0, F.col("qty_available") / daily),
        "dos_plus_on_order": F.when(daily > 0, (F.col("qty_available") + F.col("qty_on_order")) / daily),
        "pct_margin": F.when(F.col("net_sales") > 0, (F.col("net_sales") - F.col("cost_of_goods")) / F.nullif(F.col("net_sales"), F.lit(0)) * 100).otherwise(0),
        "cost_on_order": F.col("qty_on_order") * F.col("part_cost"),
        "pct_on_hand": F.when(F.col("__all") > 0, F.col("qty_available") / F.col("__all") * 100).otherwise(0),
    }).drop("__all")


def stock_overview(rows: DataFrame, key: str = "sku", n: int = 50) -> DataFrame:
    return top_rows(rows, [F.col("daily_avg").desc_nulls_last(), F.col(key)], n)


def low_stock(rows: DataFrame, key: str = "sku", n: int = 50) -> DataFrame:
    """Shortest supply first; items without sales have no supply figure and lead."""
    return top_rows(rows, [F.col("days_of_supply").asc_nulls_first(), F.col(key)], n)


def overstock(rows: DataFrame, key: str = "sku", n: int = 50) -> DataFrame:
    return top_rows(rows, [F.col("days_of_supply").desc_nulls_last(), F.col(key)], n)


def stock_breakdown(rows: DataFrame, dimension: str, value: str, n: int = 15) -> DataFrame:
    """Members of a dimension with the most stock (in a given column), and their shares of what is shown."""
    groups = rows.filter(F.col(dimension).isNotNull()).groupBy(F.col(dimension).alias("label")).agg(F.coalesce(F.sum(value), F.lit(0)).alias("value"))
    head = top_rows(groups, [F.col("value").desc(), F.col("label")], n)
    shown = F.sum("value").over(Window.partitionBy())  # n rows
    return head.select("label", "value", F.coalesce(safe_div("value", shown) * 100, F.lit(0.0)).alias("share"))


# --- purchasing -------------------------------------------------------------
def monthly_receipts(receipts: DataFrame) -> DataFrame:
    real = receipts.filter(F.col("datereceived").isNotNull() & (F.col("qty") != 0))
    return real.groupBy(F.date_format("datereceived", "yyyy-MM").alias("month_key")).agg(
        F.sum("qty").alias("qty"), F.avg("unit_cost").alias("avg_cost")
    )


def order_rollup(receipts: DataFrame) -> DataFrame:
    """Delivery dates, fill rate and lead time per purchase order."""
    day = F.col("datereceived").cast("date")
    out = receipts.filter(F.col("datereceived").isNotNull()).groupBy("purchase_order_id").agg(
        F.min("po_created_at").alias("created"), F.min(day).alias("first_delivery"), F.max(day).alias("last_delivery"),
        F.sum("qty").alias("filled"), F.max("quantity_to_fulfill").alias("total"), F.avg("precise_leadtime").alias("lead_time"),
        F.max("date_expected").alias("expected"), F.count_distinct(day).alias("deliveries"),
    )
    return out.withColumn("fill_pct", F.when(F.col("total") > 0, safe_div("filled", "total") * 100).otherwise(0))


def breakdown(receipts: DataFrame, dimension: str, n: int = 15) -> DataFrame:
    """Largest members of a dimension and one total row over all of them."""
    groups = receipts.filter(F.col(dimension).isNotNull()).groupBy(F.col(dimension).cast("string").alias("label")).agg(
        F.sum("qty").alias("qty"), F.sum("total_cost").alias("total_cost"),
        F.count_distinct("purchase_order_id").alias("deliveries"), F.avg("precise_leadtime").alias("lead_time"),
    )
    cost = F.round(safe_div("total_cost", "qty"), 2)
    head = top_rows(groups, [F.col("qty").desc_nulls_last(), F.col("label")], n).withColumn("w_avg_cost", cost)
    total = groups.agg(
        F.lit("Total").alias("label"), F.sum("qty").alias("qty"), F.sum("total_cost").alias("total_cost"),
        F.sum("deliveries").alias("deliveries"), F.avg("lead_time").alias("lead_time"),
    ).withColumn("w_avg_cost", F.when(F.col("qty") > 0, safe_div("total_cost", "qty")).otherwise(0))
    return head.unionByName(total)


def open_orders(receipts: DataFrame, as_of: str) -> DataFrame:
    """Purchase orders not yet received; overdue when the last expected day has passed."""
    waiting = receipts.filter(F.col("datereceived").isNull() & (F.col("quantity_to_fulfill") > 0))
    out = waiting.groupBy("purchase_order_id").agg(
        F.max("date_expected").alias("expected"), F.max("scheduled_fulfillment_date").alias("adjusted"),
        F.max("po_created_at").alias("created"), F.sum("qty").alias("qty"), F.sum("quantity_fulfilled").alias("filled"),
        F.sum("quantity_to_fulfill").alias("total"), F.avg("precise_leadtime").alias("lead_time_expected"),
    )
    late = F.coalesce(F.col("expected").cast("date") < F.lit(as_of).cast("date"), F.lit(False))
    return out.withColumn("fill_pct", F.when(F.col("total") > 0, safe_div("filled", "total") * 100).otherwise(0)).withColumn(
        "po_status", F.when(late, "OVERDUE").otherwise("REGULAR")
    )


def vendor_comparison(t: Tables, caliber: str, n: int = 5) -> DataFrame:
    """Fastest vendors for a caliber."""
    products = t["int_product_analyst"].filter(F.col("caliber") == caliber).select("sku")
    receipts = t["f_pos"].filter(F.col("precise_leadtime").isNotNull() & F.col("vendor_id").isNotNull())
    named = receipts.join(products, F.col("part_number") == F.col("sku")).join(t["d_vendor"].select("vendor_id", "vendor_name"), "vendor_id")
    out = named.groupBy("vendor_name").agg(
        F.round(F.avg("precise_leadtime"), 0).alias("avg_lead_time_days"), F.round(F.avg("unit_cost"), 3).alias("avg_unit_cost"),
        F.count_distinct("purchase_order_id").alias("historical_pos"), F.max("datereceived").alias("last_supplied"),
    )
    return top_rows(out, [F.col("avg_lead_time_days").asc_nulls_last(), F.col("vendor_name")], n)


# --- customers and anomalies --------------------------------------------------
# Classes that call for attention.
CONCERNING = ("At-Risk Regular", "Inactive Regular", "Lost Buyer", "Lapsed Buyer", "Losing 1-Time Buyer", "Inactive")


def segment_summary(segments: DataFrame) -> DataFrame:
    zero = F.lit(0)
    return segments.groupBy("customer_classification").agg(
        F.count(F.lit(1)).alias("customer_count"), F.coalesce(F.sum("total_revenue"), zero).alias("total_ltv"),
        F.coalesce(F.round(F.avg("days_since_last_purchase"), 0), zero).alias("avg_days_silent"),
        F.coalesce(F.round(F.avg("number_of_purchases"), 1), zero).alias("avg_purchases"),
    )


def segments_as_of(history: DataFrame, day: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Customers per class on a past day, from the segment history."""
    at = F.lit(day).cast("timestamp")
    live = (F.col(valid_from) <= at) & ((F.col(valid_to) > at) | F.col(valid_to).isNull())
    return history.filter(live).groupBy("customer_classification").agg(F.count_distinct("rank_id").alias("prior_count"))


def top_at_risk(segments: DataFrame, n: int = 10, classes: Sequence[str] = CONCERNING) -> DataFrame:
    rows = segments.filter(F.col("customer_classification").isin(list(classes)) & F.col("total_revenue").isNotNull())
    columns = ["rank_id", "customer_classification", "total_revenue", "days_since_last_purchase", "number_of_purchases",
               "total_purchases_all_time", "frequency", "recency", "customer_group"]
    return top_rows(rows.select(*columns), [F.col("total_revenue").desc(), F.col("rank_id")], n)


def recent_anomalies(anomalies: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    recent = anomalies.filter(F.col("is_anomaly") & (F.col("anomaly_date") >= F.date_sub(F.lit(as_of).cast("date"), days)))
    change = safe_div(F.col("actual_value") - F.col("expected_value"), "expected_value") * 100
    return recent.select("anomaly_date", "metric_name", "actual_value", "expected_value", F.round(change, 1).alias("deviation_pct"))


def reorder_list(advice: DataFrame) -> DataFrame:
    """Advice with the most urgent first."""
    return advice.orderBy(priority("urgency", ("Critical", "Warning", "OK", "Overstock")), F.col("days_of_supply").asc_nulls_last())
