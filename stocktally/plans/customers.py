"""Cohorts, customer segments and simple dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.functions.scalars import ladder, month_boundaries, safe_div
from stocktally.operators.windows import first_per_key
from stocktally.sources.tables import Tables


def first_month(rows: DataFrame, customer: str, day: str) -> DataFrame:
    return rows.groupBy(customer).agg(F.min(F.trunc(day, "month")).alias("cohort_month"))


def cohort_activity(
    rows: DataFrame, customer: str, day: str, by: Sequence[str] = (), all_sizes: bool = False,
) -> DataFrame:
    """Purchasers per cohort month and months since.

    Rows shrink to distinct customer-months before anything is joined, so a customer
    with a large share of the sales costs one row per month. cohort_size counts the
    group itself and is therefore zero after month 0; all_sizes adds the full size.
    """
    months = rows.filter(F.col(customer).isNotNull()).select(
        customer, F.trunc(day, "month").alias("__month"), *by
    ).distinct()
    start = months.groupBy(customer).agg(F.min("__month").alias("cohort_month"))
    offset = month_boundaries("cohort_month", "__month")
    keys = ["cohort_month", "month_number", *by]
    result = months.join(start, customer).withColumn("month_number", offset).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("purchasers"), F.count_if(F.col("month_number") == 0).alias("cohort_size"),
    )
    if all_sizes:
        sizes = start.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size_all"))
        result = result.join(sizes, "cohort_month")
    return result


def cohort_detailed(t: Tables) -> DataFrame:
    """Cohorts by manufacturer SKU, region and store.

    The first month is taken over all sales of a customer, with or without a product.
    """
    sales = t["f_sales"].filter(F.col("rank_id").isNotNull()).select(
        "rank_id", F.trunc("created_at", "month").alias("month"), "product_id", "region", "store_id"
    ).distinct()
    start = sales.groupBy("rank_id").agg(F.min("month").alias("cohort_month"))
    products = t["d_product"].select("product_id", "manufacturer_sku")
    by = ["manufacturer_sku", "region", "store_id"]
    rows = (
        sales.join(products, "product_id").select("rank_id", "month", *by).distinct().join(start, "rank_id")
        .withColumn("month_number", month_boundaries("cohort_month", "month"))
    )
    return rows.groupBy("cohort_month", "month_number", *by).agg(
        F.count(F.lit(1)).alias("purchasers"), F.count_if(F.col("month_number") == 0).alias("cohort_size")
    )


def frequency_score(n: Column, cfg: RetailConfig) -> Column:
    two, three, four = cfg.frequency_bands
    return ladder([(n == 1, 1), (n <= two, 2), (n <= three, 3), (n <= four, 4), (n >= four, 5)], 0)


def recency_score(days: Column, uppers: Sequence[int]) -> Column:
    return ladder([(days <= u, 5 - i) for i, u in enumerate(uppers)], 0)


def value_score(revenue: Column, cfg: RetailConfig) -> Column:
    low, *rest = cfg.value_bands
    return ladder([(revenue < low, 1), *[(revenue <= u, i + 2) for i, u in enumerate(rest)], (revenue > rest[-1], 5)], 0)


def margin_score(margin: Column, cfg: RetailConfig) -> Column:
    return ladder([*[(margin < u, i + 1) for i, u in enumerate(cfg.margin_bands)], (margin >= cfg.margin_bands[-1], 5)], 0)


# Class by frequency and recency score, first match wins.
CLASSES = (
    ((5,), (5,), "Super Engaged"), ((4,), (5,), "Highly Engaged"), ((5,), (4,), "Active Loyalist"),
    ((4,), (4,), "Engaged Regular"), ((3,), (4, 5), "Regular w/Potential"), ((4, 5), (3,), "At-Risk Regular"),
    ((3,), (3,), "Moderate Engager"), ((1, 2), (4,), "Relatively New Buyer"), ((1,), (5,), "New Buyer"),
    ((2,), (5,), "New Active Buyer"), ((2, 3), (1, 2), "Lapsed Buyer"), ((1,), (1,), "Inactive"),
    ((4, 5), (1,), "Lost Buyer"), ((1,), (2, 3), "Losing 1-Time Buyer"), ((2,), (3,), "Nurture Potential"),
    ((4, 5), (2,), "Inactive Regular"),
)


def purchase_summary(rows: DataFrame, customer: str, order: str, day: str, revenue: str, cost: str, as_of: str) -> DataFrame:
    """Orders of all time and the measures of the twelve full months before as_of.

    Rows are summed per customer and order first; the customer level then counts
    plain rows, so no distinct expansion is needed.
    """
    end = F.trunc(F.lit(as_of).cast("date"), "month")
    inside = (F.col(day).cast("date") >= F.add_months(end, -12)) & (F.col(day).cast("date") < end)
    per_order = rows.groupBy(customer, order).agg(
        F.max(inside).alias("in_year"), F.sum(F.when(inside, F.col(revenue))).alias("r"),
        F.sum(F.when(inside, F.col(cost))).alias("c"), F.max(F.when(inside, F.col(day).cast("date"))).alias("last"),
    )
    active = F.col("in_year") & F.col(order).isNotNull()
    summed = per_order.groupBy(customer).agg(
        F.count(order).alias("total_purchases_all_time"), F.max("in_year").alias("__any"),
        F.count_if(active).alias("__n"), F.sum("r").alias("total_revenue"), F.sum("c").alias("__cost"), F.max("last").alias("__last"),
    )
    margin = safe_div(F.col("total_revenue").cast("double") - F.col("__cost").cast("double"), F.col("total_revenue").cast("double"))
    return summed.select(
        customer, F.when(F.col("__any"), F.col("__n")).alias("number_of_purchases"), "total_revenue", margin.alias("margin"),
        F.datediff(F.date_sub(end, 1), "__last").alias("days_since_last_purchase"), "total_purchases_all_time",
    )


def score_customers(summary: DataFrame, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Frequency, recency, value and margin bands and the customer class."""
    days = F.col("days_since_last_purchase")
    scored = summary.withColumns({
        "frequency_int": frequency_score(F.col("number_of_purchases"), cfg),
        "__label": recency_score(days, cfg.recency_label_bands),
        "recency_int": recency_score(days, cfg.recency_score_bands),
        "value_int": value_score(F.col("total_revenue"), cfg),
        "margin_int": margin_score(F.col("margin"), cfg),
    })
    fr, rec = F.col("frequency_int"), F.col("__label")
    rules = [(fr.isin(list(f)) & rec.isin(list(r)), name) for f, r, name in CLASSES]
    return scored.withColumns({
        "frequency": F.concat(F.lit("F"), fr), "recency": F.concat(F.lit("R"), rec),
        "value": F.concat(F.lit("V"), "value_int"), "margin_classification": F.concat(F.lit("M"), "margin_int"),
        "monetary_value": F.concat(F.lit("MV"), F.floor((F.col("margin_int") + F.col("value_int")) / 2)),
        "customer_classification": ladder(rules, "Unclassified"),
    }).drop("__label")


def segmentation(t: Tables, as_of: str, cfg: RetailConfig = DEFAULT, normalize_email: bool = False) -> DataFrame:
    """Customer segments as of a local date.

    Sales and accounts are matched on the email as written; addresses with capital
    letters find no customer unless `normalize_email` is set.
    """
    def email(df: DataFrame, column: str) -> DataFrame:
        return df.withColumn(column, F.lower(column)) if normalize_email else df

    counted = email(t["f_sales"].filter(F.col("status").isin(list(cfg.valid_order_statuses))), "customer_email")
    summary = purchase_summary(counted, "customer_email", "order_id", "created_at", "row_total", "cost", as_of)
    base = t["magento_d_customerupdated"].join(summary, "customer_email", "left")
    accounts = t["magento_customer_entity"].select("email", "customer_group_id", "customer_id", F.lower("email").alias("__lower"))
    accounts = first_per_key(accounts, ["__lower"], [F.col("customer_id").asc_nulls_last()])
    accounts = accounts.select(F.col("__lower" if normalize_email else "email").alias("customer_email"), "customer_group_id")
    groups = t["customer_groups"].select("customer_group_id", "customer_group_code")
    named = accounts.join(groups, "customer_group_id", "left").select("customer_email", "customer_group_code")
    return score_customers(base, cfg).join(named, "customer_email", "left").select(
        "customer_email", "rank_id", "number_of_purchases", "total_revenue", "margin", "days_since_last_purchase",
        "total_purchases_all_time", "frequency", "frequency_int", "recency", "recency_int", "value", "value_int",
        "margin_classification", "margin_int", "monetary_value", "customer_classification",
        F.coalesce("customer_group_code", F.lit("Not Registered")).alias("customer_group"),
    )


# Output names of the customer dimension by input column.
CUSTOMER_COLUMNS = {
    "date_of_birth": "dob", "email": "email", "gender": "gender", "name_prefix": "prefix", "name_suffix": "suffix",
    "tax_vat_number": "taxvat", "customer_group_id": "group_id", "last_name": "lastname", "store_id": "store_id",
    "customer_id": "entity_id", "first_name": "firstname", "is_active": "is_active", "customer_created_at": "created_at",
    "created_in_store_view": "created_in", "middle_name": "middlename", "customer_updated_at": "updated_at",
    "website_id": "website_id", "confirmation_token": "confirmation", "login_failures_count": "failures_num",
    "customer_increment_id": "increment_id", "account_lock_expires_at": "lock_expires",
    "first_login_failure_at": "first_failure", "password_hash": "password_hash", "_ab_cdc_cursor": "_ab_cdc_cursor",
    "session_cutoff": "session_cutoff", "_ab_cdc_log_pos": "_ab_cdc_log_pos",
    "default_billing_address_id": "default_billing", "is_zendesk_user": "is_zendesk_user",
    "default_shipping_address_id": "default_shipping", "password_reset_token_created_at": "rp_token_created_at",
    "is_auto_group_change_disabled": "disable_auto_group_change",
    "is_mp_smtp_email_marketing_synced": "mp_smtp_email_marketing_synced",
}
STORE_COLUMNS = {
    "store_code": "code", "store_name": "name", "group_id": "group_id", "store_id": "store_id",
    "is_active": "is_active", "sort_order": "sort_order", "website_id": "website_id",
}
VENDOR_COLUMNS = (
    "vendor_id", "vendor_name", "vendor_note", "vendor_url", "lead_time_days", "status_id", "account_id", "sysuser_id",
    "tax_rate_id", "account_number", "is_active", "currency_id", "credit_limit", "date_entered", "accounting_id",
    "currency_rate", "custom_fields", "accounting_hash", "minimum_order_amount", "last_changed_user",
    "date_last_modified", "default_carrier_id", "default_ship_terms_id", "default_payment_terms_id",
    "default_carrier_service_id",
)


def customer_dimension(t: Tables) -> DataFrame:
    return _renamed(t["magento_customer_entity"], CUSTOMER_COLUMNS)


def store_dimension(t: Tables) -> DataFrame:
    return _renamed(t["magento_store"], STORE_COLUMNS)


def vendor_dimension(t: Tables) -> DataFrame:
    return _renamed(t["fishbowl_vendors"], {c: c for c in VENDOR_COLUMNS})


def _renamed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rename projection. A column that the source does not carry is an error."""
    return df.select([F.col(c).alias(o) for c, o in columns.items()])


def builders(cfg: RetailConfig = DEFAULT, as_of: str | None = None) -> dict:
    result = {
        "int_customer_cohort": lambda t: first_month(t["f_sales"], "rank_id", "created_at"),
        "f_cohort": lambda t: cohort_activity(t["f_sales"], "rank_id", "created_at"),
        "f_cohort_detailed": cohort_detailed,
        "d_customer": customer_dimension, "d_store": store_dimension, "d_vendor": vendor_dimension,
    }
    if as_of is not None:
        result["d_customer_segmentation"] = lambda t: segmentation(t, as_of, cfg)
    return result
