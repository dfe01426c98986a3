"""Change-log, join, aggregation, window, sort, set and scalar operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktally.functions import scalars as S
from stocktally.operators import aggregates as A
from stocktally.operators import cdc, identity, joins, ordering, parity
from stocktally.operators import windows as W
from stocktally.sources import silver
from workload.registry import add
from workload.tables import AS_OF, CFG, ITEM_ORDER

# --- change logs -----------------------------------------------------------------
_EV = ["user_id", "event_id", "ts", "event_type", "value"]


def _newest():
    return [F.desc("ts"), F.desc("event_id")]


def _dead():
    return F.col("event_type") == "error"


add("cdc_latest_filter_first", lambda t: cdc.cdc_latest(t["events"], ["user_id"], _newest(), _dead()).select(*_EV),
    """select user_id, event_id, ts, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r
 from events where event_type <> 'error') where r = 1""")
add("cdc_latest_wins", lambda t: cdc.cdc_latest(t["events"], ["user_id"], _newest(), _dead(), "latest_wins").select(*_EV),
    """select user_id, event_id, ts, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r
 from events) where r = 1 and event_type <> 'error'""")
add("cdc_latest_by_user_and_type", lambda t: cdc.cdc_latest(t["events"], ["user_id", "event_type"], _newest()).select(*_EV),
    """select e.user_id, event_id, ts, event_type, value from events e join (select user_id, event_type, max((ts, event_id)) as k from events group by 1, 2) m
 using (user_id, event_type) where (e.ts, e.event_id) = m.k""")
add("cdc_latest_order_lines", lambda t: t["items"].select("item_id", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"),
    "select item_id, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate from {items}")
add("cdc_null_key_guard",
    lambda t: cdc.cdc_latest(t["events"].withColumn("k", F.when(F.col("event_type") != "signup", F.col("user_id"))), ["k"], _newest(), drop_null_keys=True)
    .select("k", "event_id", "ts"),
    """select k, event_id, ts from (select *, row_number() over (partition by k order by ts desc, event_id desc) as r from (
 select case when event_type <> 'signup' then user_id end as k, event_id, ts from events) where k is not null) where r = 1""")
add("cdc_order_ts",
    lambda t: t["events"].select("event_id", S.cdc_order_ts(
        F.when(F.col("event_type") == "error", "not a time").otherwise(F.col("ts").cast("string")),
        F.unix_millis(F.col("ts").cast("timestamp"))).cast("timestamp_ntz").alias("order_ts")),
    "select event_id, case when event_type = 'error' then date_trunc('milliseconds', ts) else ts end as order_ts from events")
add("cdc_versions_per_key", lambda t: cdc.versions_per_key(t["events"], ["user_id"], _dead()),
    "select user_id, count(*) as versions, count(*) filter (event_type = 'error') as tombstones from events group by 1")
add("customer_identity", lambda t: t["magento_d_customerupdated"].select("customer_email", "rank_id"),
    "select customer_email, rank_id from {magento_d_customerupdated}")
add("dense_rank_of_parts", lambda t: identity.dense_rank_ids(t["part"].select("p_name").distinct(), "p_name", "rank_id"),
    "select p_name, row_number() over (order by p_name) as rank_id from (select distinct p_name from part)")
add("project_spec", lambda t: silver.project_spec(
    t["orders"].withColumn("flag", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)), {"o_orderkey": "order_id", "o_custkey": "customer_id", "flag": "is_finished"}, ("flag",)),
    "select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus = 'F' as is_finished from orders")
add("table_parity", lambda t: parity.table_parity(
    t["events"], t["events"].filter(F.col("event_type") != "signup"), "user_id", "ts",
    cdc.cdc_latest(t["events"], ["user_id"], _newest(), _dead()), cdc.cdc_latest(t["events"].filter(F.col("event_type") == "click"), ["user_id"], _newest(), _dead()), _dead()),
    """with l as (select distinct user_id from events where event_type <> 'error'), r as (select distinct user_id from events where event_type = 'click'),
 f as (select (select count(*) from l) as a, (select count(*) from r) as b, (select max(ts) from events) as x, (select max(ts) from events where event_type <> 'signup') as y)
 select a as left_rows, b as right_rows, a - b as row_diff, round(abs(a - b) / a * 100, 4) as pct_diff,
 cast(floor(epoch(x)) - floor(epoch(y)) as bigint) as lag_seconds, (select count(*) from events where event_type = 'error') as left_tombstones,
 (select count(*) from events where event_type = 'error') as right_tombstones, (select count(*) from l where user_id not in (select user_id from r)) as in_left_only,
 (select count(*) from r where user_id not in (select user_id from l)) as in_right_only from f""")


def _landing_orders(t):
    """Orders as a landing log: a first record on creation and one on completion."""
    base = t["orders"].select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("SO"), "o_orderkey").alias("num"), F.col("o_custkey").alias("customerid"),
        F.col("o_totalprice").alias("totalprice"), F.col("o_orderdate").alias("datecreated"), F.lit("{}").alias("customfields"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("tobeprinted"), F.col("o_orderstatus").alias("st"),
    )
    first = base.select("*", F.lit(10).alias("statusid"), F.lit(None).cast("string").alias("_ab_cdc_deleted_at"),
                        F.col("datecreated").cast("string").alias("_ab_cdc_updated_at"), F.lit(0).cast("bigint").alias("_airbyte_extracted_at"))
    later = (F.col("datecreated") + F.make_dt_interval(F.lit(1))).cast("string")
    done = base.filter(F.col("st") != "O").select(
        "*", F.lit(60).alias("statusid"), F.when(F.col("st") == "P", "gone").alias("_ab_cdc_deleted_at"), later.alias("_ab_cdc_updated_at"),
        F.lit(1).cast("bigint").alias("_airbyte_extracted_at"))
    return first.unionByName(done).drop("st")


_SO = """select o_orderkey as sales_order_id, 'SO' || o_orderkey as sales_order_number, o_custkey as customer_id, o_totalprice as total_price,
 o_orderdate as created_at, '{{}}' as custom_fields, o_orderpriority = '1-URGENT' as to_be_printed, case when o_orderstatus = 'F' then 60 else 10 end as status_id from orders"""
add("silver_sales_orders", lambda t: silver.clean("fishbowl_so", _landing_orders(t)), _SO)
add("silver_sales_orders_latest_wins", lambda t: silver.clean("fishbowl_so", _landing_orders(t), "latest_wins"), _SO + " where o_orderstatus <> 'P'")


def _landing_lines(t):
    return t["item_log"].select(
        F.col("item_id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("vendor"),
        F.col("l_quantity").alias("qty_ordered"), F.col("l_extendedprice").alias("row_total"), F.col("l_shipdate").alias("created_at"),
        (F.col("l_linenumber") > 5).cast("int").alias("is_virtual"), F.lit(None).cast("string").alias("_ab_cdc_deleted_at"),
        F.col("l_shipdate").cast("string").alias("_ab_cdc_updated_at"), F.lit(0).cast("bigint").alias("_airbyte_extracted_at"),
        F.struct(*ITEM_ORDER).alias("_ab_cdc_log_pos"))


add("silver_sales_order_items", lambda t: silver.clean("magento_sales_order_item", _landing_lines(t)),
    """select item_id as order_item_id, l_orderkey as order_id, l_partkey as product_id, l_suppkey as vendor_id, l_quantity as quantity_ordered,
 l_extendedprice as row_total, l_shipdate as item_created_at, l_linenumber > 5 as is_virtual_item from {items}""")

# --- filters -----------------------------------------------------------------------
add("filter_in_list", lambda t: t["orders"].filter(F.col("o_orderstatus").isin("F", "O")).select("o_orderkey", "o_orderstatus"),
    "select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F', 'O')")
add("filter_between", lambda t: t["orders"].filter(F.col("o_totalprice").between(100000, 200000)).select("o_orderkey", "o_totalprice"),
    "select o_orderkey, o_totalprice from orders where o_totalprice between 100000 and 200000")
add("filter_like", lambda t: t["part"].filter(F.col("p_name").ilike("%RED%") | (F.col("p_brand").like("Brand#1%") & ~F.col("p_name").ilike("%bolt%"))).select("p_partkey", "p_name"),
    "select p_partkey, p_name from part where p_name ilike '%RED%' or (p_brand like 'Brand#1%' and p_name not ilike '%bolt%')")
add("channel_by_prefix", lambda t: t["fishbowl_so"].groupBy(S.channel("sales_order_number", "GB", "GunBroker", "Website").alias("storefront")).agg(F.count(F.lit(1)).alias("orders")),
    "select case when o_orderpriority = '1-URGENT' then 'GunBroker' else 'Website' end as storefront, count(*) as orders from orders group by 1")
add("null_safe_defaults", lambda t: t["magento_sales_order"].select("order_id", F.coalesce("base_shipping_refunded", F.lit(0.0)).alias("refunded"),
    S.blank_to_null("customer_email").alias("email")),
    "select o_orderkey as order_id, case when o_orderstatus = 'F' then o_totalprice * 0.03 else 0 end as refunded, nullif(s.customer_email, '') as email from orders join {magento_sales_order} s on s.order_id = o_orderkey", "refunded")
add("having_on_aggregate", lambda t: t["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")).filter(F.col("n") >= 10),
    "select o_custkey, count(*) as n, sum(o_totalprice) as total from orders group by 1 having count(*) >= 10", "total")
add("case_ladder", lambda t: t["part"].select("p_partkey", S.ladder(
    [(F.col("p_size") <= 10, "small"), (F.col("p_size") <= 30, "medium"), (F.col("p_name").ilike("%anvil%"), "heavy")], "large").alias("size_class")),
    "select p_partkey, case when p_size <= 10 then 'small' when p_size <= 30 then 'medium' when p_name ilike '%anvil%' then 'heavy' else 'large' end as size_class from part")
add("typed_nulls_and_negative_ids", lambda t: t["orders"].select((-F.col("o_orderkey")).alias("order_id"), F.lit(None).cast("string").alias("region"), F.lit("US").alias("country")),
    "select -o_orderkey as order_id, cast(null as varchar) as region, 'US' as country from orders")
add("relative_date_windows", lambda t: t["orders"].agg(
    F.count_if(S.within_days("o_orderdate", AS_OF, -30, 0)).alias("last_30"), F.count_if(S.within_days("o_orderdate", AS_OF, 1, 30)).alias("next_30"),
    F.count_if(F.trunc("o_orderdate", "month") == F.trunc(F.lit(AS_OF).cast("date"), "month")).alias("this_month"),
    F.count_if(F.trunc("o_orderdate", "year") == F.trunc(F.lit(AS_OF).cast("date"), "year")).alias("this_year")),
    f"""select count(*) filter (o_orderdate between date '{AS_OF}' - 30 and date '{AS_OF}') as last_30,
 count(*) filter (o_orderdate between date '{AS_OF}' + 1 and date '{AS_OF}' + 30) as next_30,
 count(*) filter (date_trunc('month', o_orderdate) = date_trunc('month', date '{AS_OF}')) as this_month, count(*) filter (year(o_orderdate) = 2001) as this_year from orders""")
add("member_or_null", lambda t: t["magento_sales_order_address"].filter(S.in_or_null("region", ["NATION_1", "NATION_2"])).select("order_address_id", "region"),
    "select order_address_id, region from {magento_sales_order_address} where region in ('NATION_1', 'NATION_2') or region is null")
add("product_type_filter_drops_null", lambda t: t["magento_sales_order_item"].filter(F.col("product_type") != "configurable").groupBy("product_type").agg(F.count(F.lit(1)).alias("n")),
    "select product_type, count(*) as n from {magento_sales_order_item} where product_type <> 'configurable' group by 1")

# --- joins ---------------------------------------------------------------------------
add("inner_join", lambda t: t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total")),
    "select c_mktsegment, count(*) as orders, sum(o_totalprice) as total from orders join customer on o_custkey = c_custkey group by 1", {"total": 2})
add("left_join_chain", lambda t: t["lineitem"].join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    .join(t["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    .join(t["nation"].select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name").agg(F.sum("l_extendedprice").alias("revenue")),
    """select n_name, sum(l_extendedprice) as revenue from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
 left join nation on c_nationkey = n_nationkey group by 1""", {"revenue": 2})
add("composite_key_join", lambda t: t["item_log"].select("l_orderkey", "l_linenumber", "l_quantity").join(
    t["items"].select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("now")), ["l_orderkey", "l_linenumber"]).groupBy("l_linenumber").agg(F.sum(F.col("now") - F.col("l_quantity")).alias("drift")),
    "select l.l_linenumber, sum(i.l_quantity - l.l_quantity) as drift from lineitem l join {items} i on i.l_orderkey = l.l_orderkey and i.l_linenumber = l.l_linenumber group by 1")
add("expression_key_join", lambda t: t["magento_sales_order"].select("order_id", S.normalized_email("customer_email", CFG.default_customer_email).alias("customer_email"))
    .join(t["magento_d_customerupdated"], "customer_email").groupBy("rank_id").agg(F.count(F.lit(1)).alias("orders")),
    "select rank_id, count(*) as orders from {magento_sales_order} s join {magento_d_customerupdated} d on d.customer_email = lower(coalesce(nullif(s.customer_email, ''), 'customer@nonidentified.com')) group by 1")
add("anti_join_whole_orders", lambda t: joins.without_groups(t["lineitem"], "l_orderkey", F.col("l_quantity") == 50).select("l_orderkey", "l_linenumber", "l_quantity"),
    "select l_orderkey, l_linenumber, l_quantity from lineitem l where not exists (select 1 from lineitem x where x.l_orderkey = l.l_orderkey and x.l_quantity = 50)")
add("anti_join_ids", lambda t: joins.ids_missing_from(t["customer"].select(F.col("c_custkey").alias("id")),
    t["orders"].filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("id")), "id"),
    "select c_custkey as id from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 400000)")
add("self_join_parent", lambda t: joins.inherit_from_parent(
    t["magento_sales_order_item"].select("order_item_id", "parent_item_id", "product_type", "row_total"), "order_item_id", "parent_item_id",
    F.col("product_type") == "configurable", ["row_total"]).select("order_item_id", "row_total", "parent_row_total"),
    """select c.order_item_id, case when p.order_item_id is null then c.row_total else p.row_total end as row_total, p.row_total as parent_row_total
 from {magento_sales_order_item} c left join {magento_sales_order_item} p on p.order_item_id = c.parent_item_id and p.product_type = 'configurable'""")
add("cross_join_scalar", lambda t: joins.with_scalar_row(
    t["orders"].groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("total")), t["orders"].agg(F.sum("o_totalprice").alias("all_total")))
    .select("o_orderpriority", (F.col("total") / F.col("all_total")).alias("share")),
    "select o_orderpriority, sum(o_totalprice) / (select sum(o_totalprice) from orders) as share from orders group by 1", {"share": 6})
add("double_role_join", lambda t: t["d_product_bundle"].groupBy("num_bundle").agg(F.count_distinct("individual_num").alias("parts")),
    """select b.product_number as num_bundle, count(distinct c.product_number) as parts from {fishbowl_kititem} k join {fishbowl_product} b on b.product_id = k.kit_product_id
 join {fishbowl_product} c on c.product_id = k.component_product_id where k.kit_type_id = 10 group by 1""")
add("semi_join_history", lambda t: joins.groups_with_history(t["orders"].select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", 12),
    "select o_custkey, o_orderkey, o_orderdate from orders where o_custkey in (select o_custkey from orders group by 1 having count(distinct o_orderdate) >= 12)")
add("rows_on_latest_date", lambda t: joins.rows_on_latest(t["lineitem"].select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber"), ["l_partkey"], "l_shipdate"),
    "select l_partkey, l_shipdate, l_orderkey, l_linenumber from lineitem l where l_shipdate = (select max(l_shipdate) from lineitem x where x.l_partkey = l.l_partkey)")
add("using_join", lambda t: t["orders"].withColumnRenamed("o_custkey", "custkey").join(t["customer"].withColumnRenamed("c_custkey", "custkey"), "custkey").groupBy("custkey").agg(F.max("c_acctbal").alias("balance"), F.count(F.lit(1)).alias("orders")),
    "select o_custkey as custkey, max(c_acctbal) as balance, count(*) as orders from orders join customer on o_custkey = c_custkey group by 1")
_STATES = ", ".join(f"({lo}, {hi}, '{st}')" for lo, hi, st in S.ZIP3_STATES)


def _state_table(t):
    return t["region"].sparkSession.createDataFrame(list(S.ZIP3_STATES), "lo int, hi int, state string")


add("range_lookup_zip3", lambda t: joins.range_lookup(
    t["magento_sales_order_address"].select("order_address_id", "postcode"), S.zip3_number("postcode"), _state_table(t), "lo", "hi", "state"),
    f"""select a.order_address_id, a.postcode, r.state from {{magento_sales_order_address}} a left join (values {_STATES}) as r(lo, hi, state)
 on cast(substr(a.postcode, 1, 3) as int) between r.lo and r.hi""")
add("zip_to_state", lambda t: t["magento_sales_order_address"].groupBy(S.zip_state("postcode").alias("state")).agg(F.count(F.lit(1)).alias("addresses")),
    f"""select r.state, count(*) as addresses from {{magento_sales_order_address}} a left join (values {_STATES}) as r(lo, hi, state)
 on cast(substr(a.postcode, 1, 3) as int) between r.lo and r.hi group by 1""")
add("date_axis_fill", lambda t: joins.fill_axis(
    joins.date_axis(t["region"].sparkSession, "1995-01-01", "2001-12-31"),
    {"ordered": t["orders"].groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.sum("o_totalprice").alias("value")),
     "shipped": t["lineitem"].groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.sum("l_extendedprice").alias("value"))}, "day"),
    """select cast(d.day as date) as day, coalesce(o.v, 0) as ordered, coalesce(s.v, 0) as shipped from (select unnest(range(date '1995-01-01', date '2002-01-01', interval 1 day)) as day) d
 left join (select o_orderdate as k, sum(o_totalprice) as v from orders group by 1) o on o.k = d.day
 left join (select l_shipdate as k, sum(l_extendedprice) as v from lineitem group by 1) s on s.k = d.day""", "ordered shipped")

# --- aggregates ------------------------------------------------------------------------
add("group_aggregates", lambda t: t["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(
    F.sum("l_quantity").alias("sum_qty"), F.avg("l_extendedprice").alias("avg_price"), F.min("l_discount").alias("min_disc"), F.max("l_tax").alias("max_tax"), F.count(F.lit(1)).alias("n")),
    """select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, avg(l_extendedprice) as avg_price, min(l_discount) as min_disc, max(l_tax) as max_tax, count(*) as n
 from lineitem group by 1, 2""", "avg_price")
add("distinct_counts", lambda t: t["lineitem"].groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts")),
    "select l_suppkey, count(distinct l_partkey) as parts from lineitem group by 1")
add("conditional_distinct_count", lambda t: t["lineitem"].groupBy("l_suppkey").agg(F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("returned_orders")),
    "select l_suppkey, count(distinct case when l_returnflag = 'R' then l_orderkey end) as returned_orders from lineitem group by 1")
add("distinct_rows", lambda t: t["lineitem"].select("l_partkey", "l_suppkey").distinct(), "select distinct l_partkey, l_suppkey from lineitem")
add("margin_ratio", lambda t: t["magento_sales_order_item"].groupBy("vendor_id").agg(A.margin_pct("row_total", "base_cost", None).alias("margin_pct")),
    "select vendor_id, (sum(row_total) - sum(base_cost)) / nullif(sum(row_total), 0) * 100 as margin_pct from {magento_sales_order_item} group by 1", "margin_pct")


def _part_attributes(t):
    pairs = F.explode(F.create_map(F.lit("name"), F.col("p_name"), F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type")))
    return t["part"].select("p_partkey", pairs.alias("code", "value"))


add("pivot_max_attributes", lambda t: A.pivot_max(_part_attributes(t), ["p_partkey"], "code", "value", {"name": "name", "brand": "brand", "type": "type", "size": "size"}),
    "select p_partkey, p_name as name, p_brand as brand, p_type as type, cast(null as varchar) as size from part")
add("pivot_sum_kinds", lambda t: A.pivot_sum(
    t["lineitem"].withColumn("kind", F.concat("l_returnflag", "l_linestatus")), ["l_partkey", "l_suppkey"], "kind", "l_quantity",
    {k: "qty_" + k.lower() for k in ("AF", "AO", "NF", "NO", "RF", "RO")}),
    "select l_partkey, l_suppkey, " + ", ".join(f"coalesce(sum(l_quantity) filter (l_returnflag = '{k[0]}' and l_linestatus = '{k[1]}'), 0) as qty_{k.lower()}" for k in ("AF", "AO", "NF", "NO", "RF", "RO"))
    + " from lineitem group by 1, 2")
add("ordered_text_aggregate", lambda t: A.ordered_text(
    t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")), ["r_name"], "n_name", " > ", "nations"),
    "select r_name, string_agg(n_name, ' > ' order by n_name) as nations from nation join region on n_regionkey = r_regionkey group by 1")
add("ordered_text_with_repeats", lambda t: A.ordered_text(t["lineitem"].select("l_orderkey", "l_returnflag"), ["l_orderkey"], "l_returnflag", "", "flags"),
    "select l_orderkey, string_agg(l_returnflag, '' order by l_returnflag) as flags from lineitem group by 1")
add("mean_of_means", lambda t: A.mean_of_means(t["lineitem"], ["l_suppkey", "l_partkey"], ["l_suppkey"], "l_quantity", "avg_qty"),
    "select l_suppkey, avg(m) as avg_qty from (select l_suppkey, l_partkey, avg(l_quantity) as m from lineitem group by 1, 2) group by 1", "avg_qty")
add("count_if_and_stddev", lambda t: t["events"].groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("large"), F.stddev_samp("value").alias("spread")),
    "select event_type, count(*) filter (value > 50) as large, stddev_samp(value) as spread from events group by 1", "spread")
add("preferred_measure", lambda t: t["fishbowl_shipcarton"].join(t["magento_ups_invoice"].groupBy("tracking_number").agg(F.sum("net_amount").alias("net_amount")), "tracking_number", "left")
    .groupBy("shipment_id").agg(F.coalesce(F.sum("net_amount"), F.sum("freight_amount")).alias("amount")),
    "select c.shipment_id, coalesce(sum(i.net_amount), sum(c.freight_amount)) as amount from {fishbowl_shipcarton} c left join {invoiced} i using (tracking_number) group by 1", "amount")
add("breakdown_with_total", lambda t: A.with_total_row(
    t["orders"].groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("total")), "o_orderpriority", "Total",
    [F.sum("orders").alias("orders"), F.sum("total").alias("total")]),
    "select coalesce(o_orderpriority, 'Total') as o_orderpriority, count(*) as orders, sum(o_totalprice) as total from orders group by rollup (o_orderpriority)", {"total": 2})

# --- windows -----------------------------------------------------------------------------
add("top_n_per_key", lambda t: W.top_per_key(t["orders"].select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 3),
    "select o_custkey, o_orderkey, o_orderdate from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders) where r <= 3")
add("previous_value_per_key", lambda t: W.previous_value(t["orders"].select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderdate", "previous", ["o_orderkey"]),
    "select o_custkey, o_orderkey, o_orderdate, lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as previous from orders")
add("previous_value_hot_key", lambda t: W.previous_value(
    t["events"].select("event_type", "event_id", "ts", "value"), ["event_type"], "ts", "value", "previous", ["event_id"]),
    "select event_type, event_id, ts, value, lag(value) over (partition by event_type order by ts, event_id) as previous from events")
add("count_of_group", lambda t: W.count_of_group(t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], "lines"),
    "select l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_orderkey) as lines from lineitem")
add("share_of_group", lambda t: W.share_of_group(
    t["lineitem"].groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_extendedprice").alias("revenue")), ["l_orderkey"], "revenue", "share"),
    "select l_orderkey, l_suppkey, sum(l_extendedprice) as revenue, sum(l_extendedprice) / sum(sum(l_extendedprice)) over (partition by l_orderkey) as share from lineitem group by 1, 2", {"revenue": 4, "share": 6})

# Keys that are null form a group of their own.
_NULLED = "nullif(l_suppkey % 4, 0)"
add("count_of_group_null_keys", lambda t: W.count_of_group(
    t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", F.expr(_NULLED).alias("k"), "l_returnflag"), ["k", "l_returnflag"], "lines"),
    f"select l_orderkey, l_linenumber, l_partkey, {_NULLED} as k, l_returnflag, count(*) over (partition by {_NULLED}, l_returnflag) as lines from lineitem")
add("share_of_group_null_keys", lambda t: W.share_of_group(
    t["lineitem"].groupBy(F.expr(_NULLED).alias("k"), "l_returnflag").agg(F.sum("l_extendedprice").alias("revenue")), ["k"], "revenue", "share"),
    f"""select k, l_returnflag, revenue, revenue / sum(revenue) over (partition by k) as share
 from (select {_NULLED} as k, l_returnflag, sum(l_extendedprice) as revenue from lineitem group by 1, 2)""", {"revenue": 2, "share": 6})

def _daily(t):
    return t["orders"].groupBy(F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority").agg(F.sum("o_totalprice").alias("total"))


_DAILY = "(select cast(o_orderdate as date) as day, o_orderpriority, sum(o_totalprice) as total from orders group by 1, 2)"
add("top_n_else_other", lambda t: W.top_n_else_other(t["orders"].groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total")), "o_custkey", "total", 5)
    .groupBy("bucket").agg(F.sum("total").alias("total")),
    """select case when r <= 5 then cast(o_custkey as varchar) else 'Other' end as bucket, sum(total) as total from (select *, rank() over (order by total desc) as r from (
 select o_custkey, sum(o_totalprice) as total from orders group by 1)) group by 1""", {"total": 2})
add("trailing_frame_excluding_current", lambda t: W.trailing(_daily(t), ["o_orderpriority"], "day", "total", -28, -1, {"avg_28": "avg", "n": "count"}),
    f"select *, avg(total) over w as avg_28, count(total) over w as n from {_DAILY} window w as (partition by o_orderpriority order by day rows between 28 preceding and 1 preceding)", "total avg_28")
add("trailing_averages", lambda t: W.trailing(W.trailing(_daily(t), ["o_orderpriority"], "day", "total", -6, 0, {"avg_7": "avg"}), ["o_orderpriority"], "day", "total", -29, 0, {"avg_30": "avg"}),
    f"""select *, avg(total) over (partition by o_orderpriority order by day rows between 6 preceding and current row) as avg_7,
 avg(total) over (partition by o_orderpriority order by day rows between 29 preceding and current row) as avg_30 from {_DAILY}""", "total avg_7 avg_30")
add("running_total", lambda t: W.running_total(_daily(t), ["o_orderpriority"], "day", F.col("total"), "so_far"),
    f"select *, sum(total) over (partition by o_orderpriority order by day) as so_far from {_DAILY}", {"total": 2, "so_far": 2})
add("session_pairs", lambda t: W.session_pairs(t["events"], "user_id", "ts", "event_type", "signup", "purchase", ["event_id"]),
    """select user_id, count(*) filter (event_type = 'signup') as resume_count, avg(s) as avg_active_sec, min(s) as min_active_sec, max(s) as max_active_sec from (
 select user_id, event_type, case when event_type = 'purchase' and lag(event_type) over w = 'signup'
  then cast(floor(epoch(ts)) - floor(epoch(lag(ts) over w)) as bigint) end as s from events where event_type in ('signup', 'purchase')
 window w as (partition by user_id order by ts, event_id)) group by 1""", "avg_active_sec")
add("decreasing_steps", lambda t: W.decreasing_steps(t["events"].select("event_id", "ts", "value"), "value", "ts", ["event_id"]),
    "select * from (select event_id, ts, value, lag(value) over (order by ts, event_id) as previous_value from events) where value < previous_value")
add("earliest_per_key", lambda t: W.first_per_key(t["events"].select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], [F.asc("ts"), F.asc("event_id")]),
    "select user_id, event_type, arg_min(event_id, (ts, event_id)) as event_id, min(ts) as ts from events group by 1, 2")

# --- sorts and sets ------------------------------------------------------------------------
add("order_and_limit", lambda t: ordering.top_rows(t["orders"].select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10),
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
add("nulls_first_and_last", lambda t: ordering.top_rows(t["magento_sales_order_item"].select("order_item_id", "item_weight"), [F.col("item_weight").asc_nulls_first(), F.col("order_item_id")], 25)
    .unionByName(ordering.top_rows(t["magento_sales_order_item"].select("order_item_id", "item_weight"), [F.col("item_weight").desc_nulls_last(), F.col("order_item_id")], 25)),
    """(select order_item_id, item_weight from {magento_sales_order_item} order by item_weight asc nulls first, order_item_id limit 25) union all
 (select order_item_id, item_weight from {magento_sales_order_item} order by item_weight desc nulls last, order_item_id limit 25)""")
add("custom_priority_order", lambda t: ordering.top_rows(t["orders"].select("o_orderkey", "o_orderpriority"),
    [ordering.priority("o_orderpriority", ("3-MEDIUM", "1-URGENT", "5-LOW")), F.col("o_orderkey")], 40),
    """select o_orderkey, o_orderpriority from orders order by case o_orderpriority when '3-MEDIUM' then 1 when '1-URGENT' then 2 when '5-LOW' then 3 else 4 end, o_orderkey limit 40""")
add("union_all_branches", lambda t: ordering.labelled_stack(
    {"customer": t["customer"].select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")),
     "supplier": t["supplier"].select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))}, "party", ["id", "balance"]),
    "select 'customer' as party, c_custkey as id, c_acctbal as balance from customer union all select 'supplier', s_suppkey, s_acctbal from supplier")
add("two_way_difference", lambda t: ordering.two_way_difference(
    t["orders"].filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("id")), t["orders"].filter(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("id")), "id"),
    """select distinct o_custkey as id, 'left' as only_in from orders where o_orderstatus = 'F' and o_custkey not in (select o_custkey from orders where o_orderstatus = 'O')
 union all select distinct o_custkey, 'right' from orders where o_orderstatus = 'O' and o_custkey not in (select o_custkey from orders where o_orderstatus = 'F')""")

# --- scalars -------------------------------------------------------------------------------
add("wall_clock_shift", lambda t: t["events"].select("event_id", S.wall_clock("ts", CFG.timezone).alias("local_ts")),
    f"select event_id, (ts at time zone 'UTC') at time zone '{CFG.timezone}' as local_ts from events")
add("timestamp_text", lambda t: t["events"].select("event_id", S.clock_text("ts").alias("clock"), S.clock_text(F.date_trunc("hour", "ts")).alias("hour_text")),
    "select event_id, strftime(ts, '%H:%M:%S') as clock, strftime(date_trunc('hour', ts), '%H:%M:%S') as hour_text from events")
add("json_path_text", lambda t: t["events"].select("event_id", S.json_text("props", "k").alias("k"), S.json_text("event_type", "k").alias("broken")),
    "select event_id, json_extract_string(props, '$.k') as k, cast(null as varchar) as broken from events")
add("date_parts", lambda t: t["events"].select("event_id", S.trunc_ntz("hour", "ts").alias("hour"), F.trunc("ts", "week").alias("week"), F.trunc("ts", "month").alias("month"), F.hour("ts").alias("h")),
    "select event_id, date_trunc('hour', ts) as hour, cast(date_trunc('week', ts) as date) as week, cast(date_trunc('month', ts) as date) as month, hour(ts) as h from events")
add("date_arithmetic", lambda t: t["orders"].select("o_orderkey", F.date_add(F.col("o_orderdate").cast("date"), 14).alias("due"),
    F.datediff(F.lit(AS_OF).cast("date"), "o_orderdate").alias("age_days"), S.month_boundaries("o_orderdate", F.lit(AS_OF).cast("date")).alias("age_months")),
    f"""select o_orderkey, cast(o_orderdate as date) + 14 as due, datediff('day', o_orderdate, date '{AS_OF}') as age_days,
 datediff('month', o_orderdate, date '{AS_OF}') as age_months from orders""")
add("split_and_cast", lambda t: t["orders"].select("o_orderkey", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("level"),
    F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).try_cast("int").alias("n"), F.col("o_orderpriority").try_cast("int").alias("bad")),
    "select o_orderkey, split_part(o_orderpriority, '-', 1) as level, try_cast(split_part(o_orderpriority, '-', 1) as int) as n, try_cast(o_orderpriority as int) as bad from orders")
add("split_and_explode_ids", lambda t: t["magento_catalog_product_entity_text"].filter(F.col("attribute_id") == 682)
    .select("entity_id", F.explode(S.id_list("value")).alias("option_id")).filter(F.col("option_id").isNotNull()),
    """select entity_id, option_id from (select entity_id, try_cast(trim(unnest(string_split(value, ','))) as bigint) as option_id
 from {magento_catalog_product_entity_text} where attribute_id = 682) where option_id is not null""")
add("text_functions", lambda t: t["part"].select("p_partkey", F.lower("p_brand").alias("lo"), F.upper("p_name").alias("up"), F.trim(F.concat(F.lit(" "), "p_type")).alias("tr"),
    F.concat(F.col("p_brand"), F.lit("@"), F.col("p_partkey").cast("string")).alias("k"), F.length("p_name").alias("n"), F.col("p_name").rlike("^(red|hot)").alias("m")),
    "select p_partkey, lower(p_brand) as lo, upper(p_name) as up, trim(' ' || p_type) as tr, p_brand || '@' || p_partkey as k, length(p_name) as n, regexp_matches(p_name, '^(red|hot)') as m from part")
add("numeric_functions", lambda t: t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", F.ceil("l_extendedprice").alias("up"), F.floor("l_extendedprice").alias("down"),
    F.abs(F.col("l_quantity") - 25).alias("dist"), F.power("l_quantity", F.lit(2)).alias("sq"), F.greatest("l_quantity", F.lit(10)).alias("atleast"), F.nullif("l_discount", F.lit(0.0)).alias("disc")),
    """select l_orderkey, l_linenumber, l_partkey, cast(ceil(l_extendedprice) as bigint) as up, cast(floor(l_extendedprice) as bigint) as down, abs(l_quantity - 25) as dist,
 power(l_quantity, 2) as sq, greatest(l_quantity, 10) as atleast, nullif(l_discount, 0) as disc from lineitem""")
add("try_casts", lambda t: t["events"].select("event_id", F.try_to_timestamp("event_type").alias("bad_ts"), S.json_text("props", "k").cast("decimal(38,9)").cast("double").alias("k")),
    "select event_id, try_cast(event_type as timestamp) as bad_ts, cast(json_extract_string(props, '$.k') as double) as k from events")
add("week_of_month_and_labels", lambda t: t["events"].select("event_id", S.week_of_month("ts").alias("wom"), F.weekday("ts").alias("dow"), S.hour_label(F.hour("ts")).alias("label")),
    """select event_id, cast((day(ts) - 1) // 7 + 1 as int) as wom, isodow(ts) - 1 as dow,
 (case when hour(ts) % 12 = 0 then 12 else hour(ts) % 12 end) || ':00 ' || case when hour(ts) < 12 then 'AM' else 'PM' end as label from events""")
add("uom_conversion", lambda t: t["fishbowl_receiptitem"].select("receipt_item_id", "uom_id", "quantity_received").join(
    t["fishbowl_uomconversion"].select(F.col("from_uom_id").alias("uom_id"), "multiply_factor", "factor"), "uom_id", "left").select(
    "receipt_item_id", S.uom_convert("quantity_received", "uom_id", F.lit(1), "multiply_factor", "factor").alias("guarded"),
    S.uom_convert("quantity_received", "uom_id", F.lit(1), "multiply_factor", "factor", zero_factor_as_one=True).alias("zero_as_one")),
    """select r.receipt_item_id, case when r.uom_id <> 1 then r.quantity_received * u.multiply_factor / nullif(u.factor, 0) else r.quantity_received end as guarded,
 case when r.uom_id <> 1 then r.quantity_received * u.multiply_factor / case when u.factor = 0 then 1 else u.factor end else r.quantity_received end as zero_as_one
 from {fishbowl_receiptitem} r left join {fishbowl_uomconversion} u on u.from_uom_id = r.uom_id""", "guarded zero_as_one")
