"""Usage cost, freshness, data quality, sinks and streams."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from stocktally.plans import quality, usage
from stocktally.session import shared_folder
from stocktally.sources import readers, sinks
from stocktally.streaming import keyed, live
from workload.registry import add

AS_OF = "2024-01-20"
NOW = "2024-01-30 12:00:00"

# --- usage cost over the event stream ---------------------------------------------------
# Event type stands for the metered resource, user for the consumer, value for credits.


def _metering(t):
    return t["events"].select(F.col("event_type").alias("resource"), "ts", F.col("value").alias("credits"), "user_id", "event_id")


def _work(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t["events"].filter(F.col("event_type") != "error").select(
        F.col("event_type").alias("resource"), "ts", (F.col("value") * 137.31).alias("ms"), "user_id", "event_id",
        F.when(k < 50, "POWERBI_ROLE").otherwise("STREAMLIT_ROLE").alias("role_name"),
        F.when(k < 20, "").when(k < 40, "dbt:gold").when(k < 60, "airbyte:sync").otherwise("other tag").alias("query_tag"))


_WORK = """(select event_type as resource, ts, value * 137.31 as ms, user_id, event_id, case when k < 50 then 'POWERBI_ROLE' else 'STREAMLIT_ROLE' end as role_name,
 case when k < 20 then '' when k < 40 then 'dbt:gold' when k < 60 then 'airbyte:sync' else 'other tag' end as query_tag from (
 select *, cast(json_extract_string(props, '$.k') as int) as k from events where event_type <> 'error'))"""
add("usage_month_to_date", lambda t: usage.month_to_date(
    t["orders"].select("o_orderdate", "o_totalprice"), "o_orderdate", "o_totalprice", "2001-06-15"),
    """with s as (select sum(o_totalprice) filter (o_orderdate between date '2001-06-01' and date '2001-06-15') as c, sum(o_totalprice) filter (o_orderdate between date '2001-05-01' and date '2001-05-15') as p from orders)
 select round(c, 2) as credits_mtd, round(c * 3, 2) as dollars_mtd, round(coalesce(p, 0), 2) as credits_prior_mtd, round(coalesce(p, 0) * 3, 2) as dollars_prior_mtd, 15 as days_elapsed from s""")
add("usage_daily_cost", lambda t: usage.cost_by(_metering(t), [F.col("ts").cast("date").alias("usage_date"), "resource"], "credits"),
    "select cast(ts as date) as usage_date, event_type as resource, round(sum(value), 2) as credits, round(sum(value) * 3, 2) as dollars from events group by 1, 2")
add("usage_monthly_cost", lambda t: usage.cost_by(t["orders"], [F.trunc("o_orderdate", "month").alias("month"), "o_orderpriority"], "o_totalprice"),
    "select cast(date_trunc('month', o_orderdate) as date) as month, o_orderpriority, round(sum(o_totalprice), 2) as credits, round(sum(o_totalprice) * 3, 2) as dollars from orders group by 1, 2")


def _shares(t, who):
    return usage.hourly_allocation(_metering(t), _work(t).withColumn("tag", usage.tag_label("query_tag")), "resource", "ts", "credits", "ms", who)


def _alloc(who: str) -> str:
    return f"""select {who}, w.resource, w.hour, c.credits * w.ms / nullif(w.all_ms, 0) as credits from (
 select {who}, resource, date_trunc('hour', ts) as hour, sum(ms) as ms, sum(sum(ms)) over (partition by resource, date_trunc('hour', ts)) as all_ms
 from (select *, case when query_tag = '' then '<untagged>' else query_tag end as tag from {_WORK}) group by {who}, resource, date_trunc('hour', ts)) w
 join (select event_type as resource, date_trunc('hour', ts) as hour, sum(value) as credits from events group by 1, 2) c on c.resource = w.resource and c.hour = w.hour"""


def _cost(who: str, keys: str) -> str:
    return f"""select * from (select {keys}, round(sum(credits), 2) as credits, round(sum(credits) * 3, 2) as dollars from ({_alloc(who)}) group by {keys}) where credits > 0"""


add("usage_hourly_allocation", lambda t: _shares(t, ["user_id"]), _alloc("user_id"), "credits")
add("usage_cost_by_user", lambda t: usage.allocated_cost(_shares(t, ["user_id", "role_name"]), ["user_id", "role_name"]), _cost("user_id, role_name", "user_id, role_name"))
add("usage_cost_by_tag", lambda t: usage.allocated_cost(_shares(t, ["tag"]), ["tag", "resource"]), _cost("tag", "tag, resource"))
add("usage_daily_top_users", lambda t: usage.daily_top_users(_shares(t, ["user_id"]), "user_id", 5),
    f"""with d as (select cast(hour as date) as usage_date, user_id, sum(credits) as credits from ({_alloc('user_id')}) group by 1, 2),
 r as (select user_id, rank() over (order by sum(credits) desc) as k from d where credits > 0 group by 1)
 select usage_date, case when k <= 5 then cast(user_id as varchar) else 'Other' end as bucket, round(sum(credits), 2) as credits, round(sum(credits) * 3, 2) as dollars
 from d join r using (user_id) where credits > 0 group by 1, 2""")
_DAYS = "(select cast(o_orderdate as date) as usage_date, sum(o_totalprice) as credits from orders group by 1)"


def _daily_orders(t):
    return t["orders"].groupBy(F.col("o_orderdate").cast("date").alias("usage_date")).agg(F.sum("o_totalprice").alias("credits"))


add("usage_cost_anomalies", lambda t: usage.cost_anomalies(_daily_orders(t), "usage_date", "credits"),
    f"""select usage_date, round(credits, 2) as credits, round(credits * 3, 2) as dollars, round(coalesce(m, 0), 2) as baseline_28d_credits,
 case when n < 7 then 'insufficient-history' when credits > m * 2.5 then 'ANOMALY' else 'normal' end as status from (select *, avg(credits) over w as m, count(*) over w as n from {_DAYS}
 window w as (order by usage_date rows between 28 preceding and 1 preceding))""", {"baseline_28d_credits": 1, "credits": 1, "dollars": 1})
_RES = "(select event_type as resource, cast(ts as date) as usage_date, sum(value) as total_credits from events group by 1, 2)"


def _resource_days(t):
    return t["events"].groupBy(F.col("event_type").alias("resource"), F.col("ts").cast("date").alias("usage_date")).agg(F.sum("value").alias("total_credits"))


add("usage_spikes", lambda t: usage.spike_status(_resource_days(t), ["resource"], "usage_date", "total_credits"),
    f"""select resource, usage_date, round(total_credits, 4) as total_credits, round(m, 4) as rolling_7d_avg, round(s, 4) as rolling_7d_stddev, round(total_credits / nullif(m, 0), 2) as ratio_vs_avg,
 case when total_credits > m + 2 * coalesce(s, 0) then 'SPIKE' when total_credits < m * 0.2 then 'DROP' else 'NORMAL' end as anomaly_status
 from (select *, avg(total_credits) over w as m, stddev_samp(total_credits) over w as s from {_RES} window w as (partition by resource order by usage_date rows between 7 preceding and 1 preceding)) where m is not null""",
    {"total_credits": 3, "rolling_7d_avg": 3, "rolling_7d_stddev": 3})
add("usage_rolling_cost", lambda t: usage.rolling_cost(_resource_days(t), ["resource"], "usage_date", "total_credits"),
    f"""select *, avg(total_credits) over (partition by resource order by usage_date rows 6 preceding) as credits_7d_avg,
 avg(total_credits) over (partition by resource order by usage_date rows 29 preceding) as credits_30d_avg from {_RES}""", "total_credits credits_7d_avg credits_30d_avg")
add("usage_utilization", lambda t: usage.with_event_counts(
    usage.utilization(t["events"].withColumn("queued", F.col("value") / 10).withColumn("blocked", F.lit(0)), "user_id", "ts", "value", "queued", "blocked"),
    t["events"], "user_id", "ts", "event_type", "signup", "purchase"),
    """select h.*, coalesce(c.r, 0) as resume_count, coalesce(c.s, 0) as suspend_count from (
 select cast(hour as date) as usage_date, user_id, count(*) filter (r > 0) as active_hours, 24 - count(*) filter (r > 0) as idle_hours, round(count(*) filter (r > 0) / 24.0 * 100, 1) as utilization_pct,
  avg(r) as avg_concurrency, max(peak) as peak_concurrency, sum(q) as total_queued, sum(b) as total_blocked from (select date_trunc('hour', ts) as hour, user_id, avg(value) as r, avg(value / 10) as q,
  avg(0) as b, max(value) as peak from events group by 1, 2) group by 1, 2) h left join (select cast(ts as date) as d, user_id, count(*) filter (event_type = 'signup') as r,
  count(*) filter (event_type = 'purchase') as s from events group by 1, 2) c on c.d = h.usage_date and c.user_id = h.user_id""", "avg_concurrency total_queued total_blocked")
add("usage_cost_center", lambda t: usage.query_cost(_work(t), [F.col("ts").cast("date").alias("usage_date"), usage.cost_center("query_tag", "role_name").alias("cost_center")], "ms", "event_id", "ms")
    .select("usage_date", "cost_center", "query_count", "total_elapsed_sec", "avg_elapsed_sec"),
    f"""select cast(ts as date) as usage_date, case when query_tag ilike 'dbt%' then 'dbt' when query_tag ilike 'airbyte%' then 'airbyte' when role_name in ('POWERBI_ROLE', 'POWERBI_READONLY_ROLE') then 'powerbi'
 when role_name = 'STREAMLIT_ROLE' then 'streamlit' else 'other' end as cost_center, count(*) as query_count, round(sum(ms) / 1000.0, 1) as total_elapsed_sec, round(avg(ms) / 1000.0, 2) as avg_elapsed_sec
 from {_WORK} group by 1, 2""")
add("usage_tagged_cost", lambda t: usage.tagged_cost(
    t["orders"].select(F.col("o_custkey").alias("resource"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("credits")),
    t["customer"].select(F.col("c_custkey").alias("resource"), F.col("c_mktsegment").alias("cost_center")), "resource", "ts", "credits"),
    """select c_mktsegment as cost_center, o_custkey as resource, cast(o_orderdate as date) as usage_date, sum(o_totalprice) as compute_credits, sum(o_totalprice) * 3 as estimated_cost_usd
 from orders join customer on c_custkey = o_custkey group by 1, 2, 3""", "compute_credits estimated_cost_usd")
add("usage_idle_spend", lambda t: usage.idle_spend(
    _metering(t).groupBy("resource", F.date_trunc("hour", "ts").alias("ts")).agg(F.sum("credits").alias("credits")),
    t["events"].filter(F.col("value") > 60).groupBy(F.col("event_type").alias("resource"), F.date_trunc("hour", "ts").alias("ts")).agg(F.count(F.lit(1)).alias("running")),
    "resource", "ts", "credits", "running").select("resource", F.col("hour_ts").cast("timestamp_ntz").alias("hour_ts"), "credits_used"),
    """select event_type as resource, date_trunc('hour', ts) as hour_ts, sum(value) as credits_used from events group by 1, 2
 having sum(value) > 0 and count(*) filter (value > 60) = 0""", "credits_used")
add("usage_expensive_queries", lambda t: usage.expensive_queries(t["events"].select("event_id", "value"), "value", "event_id"),
    "select event_id, value from events order by value desc, event_id limit 20")
add("usage_badly_pruned", lambda t: usage.badly_pruned(
    t["lineitem"].groupBy("l_orderkey").agg(F.sum("l_quantity").alias("scanned"), (F.count(F.lit(1)) * 50).alias("total")), "scanned", "total", "l_orderkey"),
    """select *, round(scanned / nullif(total, 0) * 100, 1) as scan_pct from (select l_orderkey, sum(l_quantity) as scanned, count(*) * 50 as total from lineitem group by 1)
 where total > 100 and scanned / nullif(total, 0) > 0.8 order by scanned desc, l_orderkey limit 20""")
add("usage_spilling", lambda t: usage.spilling(t["lineitem"].groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("near"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(0)).alias("far")), "near", "far", "l_orderkey")
    .select("l_orderkey", "far"),
    "select l_orderkey, sum(case when l_returnflag = 'R' then l_extendedprice else 0 end) as far from lineitem group by 1 order by 2 desc, 1 limit 20", {"far": 2})
_STORE = "(select cast(o_orderdate as date) as day, o_orderpriority as db, sum(o_totalprice) * 1e6 as active, sum(o_totalprice) * 1e5 as failsafe from orders group by 1, 2)"


def _storage(t):
    return t["orders"].groupBy(F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderpriority").alias("db")).agg(
        (F.sum("o_totalprice") * 1e6).alias("active"), (F.sum("o_totalprice") * 1e5).alias("failsafe"))


add("usage_storage_snapshot", lambda t: usage.storage_snapshot(_storage(t), "day", "db", "active", "failsafe", "2001-06-15"),
    f"""select db, round(active / 1073741824, 2) as active_gb, round(failsafe / 1073741824, 2) as failsafe_gb, round((active + failsafe) / 1073741824, 2) as total_gb from {_STORE}
 where day = date '2001-06-14' and active > 0""")
add("usage_storage_growth", lambda t: usage.storage_growth(
    _storage(t), t["lineitem"].groupBy(F.col("l_shipdate").cast("date").alias("day")).agg((F.sum("l_extendedprice") * 1e6).alias("active")), "day", "db", "active", "failsafe"),
    f"""select day, db, round(active / 1099511627776, 6) as active_tb, round(failsafe / 1099511627776, 6) as failsafe_tb, round((active + failsafe) / 1099511627776, 6) as total_tb,
 round((active + failsafe) / 1099511627776 * 23, 2) as estimated_monthly_cost_usd from (select * from {_STORE} union all select cast(l_shipdate as date), 'STAGES', sum(l_extendedprice) * 1e6, 0 from lineitem group by 1)""",
    {"active_tb": 5, "failsafe_tb": 5, "total_tb": 5})
add("usage_combined_monthly", lambda t: usage.combined_monthly({
    "orders": t["orders"].groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.sum("o_totalprice").alias("value")),
    "lines": t["lineitem"].groupBy(F.trunc("l_shipdate", "month").alias("month")).agg(F.sum("l_extendedprice").alias("value"))}, t["orders"].sparkSession, "2001-06-15", 12),
    """select *, orders + lines as total from (select cast(m as date) as month, coalesce(o.v, 0) as orders, coalesce(l.v, 0) as lines from (select unnest(range(date '2000-07-01', date '2001-07-01', interval 1 month)) as m)
 left join (select date_trunc('month', o_orderdate) as k, sum(o_totalprice) as v from orders group by 1) o on o.k = m
 left join (select date_trunc('month', l_shipdate) as k, sum(l_extendedprice) as v from lineitem group by 1) l on l.k = m)""", {"orders": 2, "lines": 2, "total": 2})

# --- freshness ---------------------------------------------------------------------------
_STALE = f"cast(datediff('minute', %s, timestamp '{NOW}') as bigint)"


def _streams(t):
    return usage.stream_freshness(t["events"], "event_type", "user_id", "ts", NOW)


def _limits(t):
    return t["events"].groupBy("event_type").agg(F.lit(5).alias("warn_minutes"), F.lit(60).alias("alert_minutes"))


_CONN = f"""(select *, case when staleness_min >= alert_minutes then 'ALERT' when staleness_min >= warn_minutes then 'WARN' else 'OK' end as status from (
 select event_type, min(m) as oldest_extracted_at, max(m) as newest_extracted_at, count(*) as table_count, {_STALE % 'max(m)'} as staleness_min, 5 as warn_minutes, 60 as alert_minutes
 from (select event_type, user_id, max(ts) as m from events group by 1, 2) group by 1))"""
add("freshness_per_stream", _streams, f"select event_type, user_id, max(ts) as last_extracted_at, {_STALE % 'max(ts)'} as staleness_min from events group by 1, 2")
add("freshness_per_connection", lambda t: usage.connection_freshness(_streams(t), _limits(t), "event_type", NOW), f"select * from {_CONN}")
add("freshness_crossed", lambda t: usage.crossed_since(
    usage.connection_freshness(usage.stream_freshness(t["events"], "user_id", "event_type", "ts", "2024-01-30 23:59:00"),
                               t["events"].groupBy("user_id").agg(F.lit(60).alias("warn_minutes"), F.lit(600).alias("alert_minutes")), "user_id", "2024-01-30 23:59:00"),
    "WARN", "warn_minutes", "2024-01-30 23:59:00", "2024-01-30 21:59:00").select("user_id", "staleness_min"),
    """select user_id, staleness_min from (select user_id, cast(datediff('minute', max(ts), timestamp '2024-01-30 23:59:00') as bigint) as staleness_min from events group by 1)
 where staleness_min >= 60 and staleness_min < 600 and staleness_min < 60 + 120""")
add("repeat_incidents", lambda t: usage.repeat_incidents(t["events"], "user_id", "ts", "event_type", "error", "2024-01-30 12:00:00", 2880),
    "select user_id, count(*) as n from events where event_type = 'error' and ts >= timestamp '2024-01-28 12:00:00' group by 1")
add("first_abnormal_event", lambda t: usage.first_abnormal_of_log(
    t["events"], ["user_id", F.col("ts").cast("date").alias("day")], "event_type", "ts", F.when(F.col("event_type") == "error", 2).otherwise(1)).drop("started"),
    """select user_id, cast(ts as date) as day, event_type as first_reason, ts as first_event_ts, case when event_type = 'error' then 2 else 1 end as event_count,
 case when event_type = 'error' then 'inferred' else 'authoritative' end as confidence from (
 select *, row_number() over (partition by user_id, cast(ts as date) order by ts, event_type) as r from events) where r = 1""")

# --- data quality --------------------------------------------------------------------------
_CHECKS = {
    "match_regex": ("part", "p_name", {"pattern": "^(red|blue|hot) "}, "not regexp_matches(p_name, '^(red|blue|hot) ')"),
    "date_range": ("orders", "o_orderdate", {"start": "1996-01-01", "end": "2000-12-31"}, "o_orderdate < date '1996-01-01' or o_orderdate > date '2000-12-31'"),
    "non_negative": ("customer", "c_acctbal", {}, "c_acctbal < 0"),
    "numeric_range": ("lineitem", "l_quantity", {"low": 5, "high": 45}, "l_quantity < 5 or l_quantity > 45"),
    "recent_update": ("orders", "o_orderdate", {"days": 365, "as_of": "2001-08-01"}, "o_orderdate < date '2001-08-01' - 365"),
    "valid_date": ("orders", "o_orderpriority", {}, "try_cast(o_orderpriority as date) is null"),
    "valid_email": ("magento_sales_order", "customer_email", {}, "customer_email not like '%_@__%.__%'"),
    "valid_zip": ("magento_sales_order_address", "postcode", {}, "not regexp_matches(postcode, '^[0-9]{{5}}-?[0-9]{{3}}$')"),
    "max_length": ("part", "p_name", {"limit": 9}, "length(p_name) > 9"),
    "min_length": ("part", "p_name", {"limit": 9}, "length(p_name) < 9"),
    "no_future_dates": ("orders", "o_orderdate", {"as_of": "2001-01-01"}, "o_orderdate > date '2001-01-01'"),
    "no_past_dates": ("orders", "o_orderdate", {"as_of": "1996-01-01"}, "o_orderdate < date '1996-01-01'"),
    "not_null": ("magento_sales_order_address", "region", {}, "region is null"),
    "no_special_characters": ("part", "p_brand", {}, "regexp_matches(p_brand, '[^a-zA-Z0-9\\s]')"),
    "values_in_list": ("orders", "o_orderstatus", {"values": ["F", "O"]}, "o_orderstatus not in ('F', 'O')"),
}
for _rule, (_table, _column, _args, _where) in _CHECKS.items():
    _source = _table if _table in ("part", "orders", "customer", "lineitem") else "{" + _table + "}"
    add(f"expect_{_rule}", lambda t, a=_table, r=_rule, c=_column, k=_args: quality.expect(t[a], r, c, **k), f"select * from {_source} where {_where}")
add("expect_unique", lambda t: quality.expect(t["part"], "unique", "p_name"), "select p_name, count(*) as n from part group by 1 having count(*) > 1")
add("expect_relationships", lambda t: quality.expect(
    t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey"), "relationships", "l_orderkey", to=t["orders"].filter(F.col("o_orderstatus") != "P"), field="o_orderkey"),
    "select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')")
add("expect_increasing_over_time", lambda t: quality.expect(t["events"].select("event_id", "ts", "value"), "increasing_over_time", "value", date_column="ts", tiebreak=["event_id"]),
    "select * from (select event_id, ts, value, lag(value) over (order by ts, event_id) as previous_value from events) where value < previous_value")
add("quality_report", lambda t: quality.report(t["lineitem"], [
    quality.Expectation("non_negative", "l_quantity"), quality.Expectation("numeric_range", "l_discount", (("low", 0.01), ("high", 0.09)), "error"),
    quality.Expectation("not_null", "l_shipdate"), quality.Expectation("values_in_list", "l_returnflag", (("values", ("A", "N")),))]),
    """select 'non_negative' as rule, 'l_quantity' as column_name, 'warn' as severity, count(*) filter (l_quantity < 0) as violations, case when count(*) filter (l_quantity < 0) = 0 then 'pass' else 'warn' end as status from lineitem
 union all select 'numeric_range', 'l_discount', 'error', count(*) filter (l_discount < 0.01 or l_discount > 0.09), case when count(*) filter (l_discount < 0.01 or l_discount > 0.09) = 0 then 'pass' else 'error' end from lineitem
 union all select 'not_null', 'l_shipdate', 'warn', count(*) filter (l_shipdate is null), case when count(*) filter (l_shipdate is null) = 0 then 'pass' else 'warn' end from lineitem
 union all select 'values_in_list', 'l_returnflag', 'warn', count(*) filter (l_returnflag not in ('A', 'N')), case when count(*) filter (l_returnflag not in ('A', 'N')) = 0 then 'pass' else 'warn' end from lineitem""")

# --- sinks and streams ---------------------------------------------------------------------


def _scratch(spark, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _merge_orders(t):
    spark = t["orders"].sparkSession
    path = _scratch(spark, "merge") + "/orders"
    rows = t["orders"].select("o_orderkey", "o_totalprice", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("ym"))
    sinks.write_table(rows.filter(F.col("o_orderstatus") != "O"), path, partition_by=["ym"])
    recent = rows.filter(F.col("ym") >= "2001-06").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    sinks.merge_by_key(spark, path, recent, ["o_orderkey"], "ym")
    return sinks.read_table(spark, path).withColumn("ym", F.col("ym").cast("string"))


add("merge_by_key", _merge_orders,
    """select o_orderkey, case when ym >= '2001-06' then o_totalprice + 1 else o_totalprice end as o_totalprice, o_orderstatus, ym from (
 select *, strftime(o_orderdate, '%Y-%m') as ym from orders) where o_orderstatus <> 'O' or ym >= '2001-06'""".replace("*, strftime", "o_orderkey, o_totalprice, o_orderstatus, strftime"))


def _archive(t):
    spark = t["orders"].sparkSession
    root = _scratch(spark, "archive")
    one = t["orders"].groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("v")).withColumn("kind", F.lit("priority"))
    two = t["orders"].groupBy(F.col("o_orderstatus").alias("o_orderpriority")).agg(F.sum("o_totalprice").alias("v")).withColumn("kind", F.lit("status"))
    for frame, kind, at in ((one, "priority", "2001-01-01"), (two, "status", "2001-01-01"), (one.withColumn("v", F.col("v") * 2), "priority", "2001-02-01")):
        sinks.archive_then_overwrite(spark, f"{root}/current", f"{root}/history", frame, "kind", kind, at)
    current = sinks.read_table(spark, f"{root}/current").withColumn("state", F.lit("current"))
    past = sinks.read_table(spark, f"{root}/history").drop("archived_at").withColumn("state", F.lit("archived"))
    return current.unionByName(past).withColumn("kind", F.col("kind").cast("string"))


add("archive_then_overwrite", _archive,
    """select o_orderpriority, sum(o_totalprice) * 2 as v, 'priority' as kind, 'current' as state from orders group by 1 union all
 select o_orderstatus, sum(o_totalprice), 'status', 'current' from orders group by 1 union all select o_orderpriority, sum(o_totalprice), 'priority', 'archived' from orders group by 1""", {"v": 2})


def _export(t):
    spark = t["orders"].sparkSession
    path = _scratch(spark, "export") + "/rows"
    sinks.export_parquet(t["orders"].select("o_orderkey", "o_orderstatus"), path)
    sinks.register_view(spark.read.parquet(path), "exported_orders")
    return spark.sql("select o_orderstatus, count(*) as orders from exported_orders group by o_orderstatus")


add("export_and_view", _export, "select o_orderstatus, count(*) as orders from orders group by 1")


def _event_stream(t):
    """The events as a bounded stream of files, as many as their scan has tasks and two at least; half come per trigger."""
    spark = t["events"].sparkSession
    folder = _scratch(spark, "stream") + "/events"
    odd = F.coalesce(F.col("user_id") % 2, F.lit(1)) != 0  # events without a user are in one part too
    t["events"].filter(~odd).write.parquet(folder)
    t["events"].filter(odd).write.mode("append").parquet(folder)
    files = len(spark.read.parquet(folder).inputFiles())
    return spark, spark.readStream.schema(t["events"].schema).option("maxFilesPerTrigger", -(-files // 2)).parquet(folder), folder


_BUCKETS = 16  # folders of the stored table
_NEWEST = ["ts", "event_id"]


def _stream_upsert(t, compacted=False, **mode):
    spark, stream, folder = _event_stream(t)
    out = folder + "-out"
    bucketed = stream.withColumn("bucket", F.col("user_id") % _BUCKETS)
    keyed.keyed_upsert(bucketed, out, ["user_id"], _NEWEST, out + "-progress", partition_by="bucket", **mode).awaitTermination()
    if compacted:
        keyed.compact(spark, out, ["user_id"], _NEWEST)
    return keyed.upserted(spark, out, ["user_id"], _NEWEST).drop("bucket")


add("stream_cdc_upsert", _stream_upsert, """select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
_GONE = "event_type = 'purchase'"
add("stream_cdc_delete", lambda t: _stream_upsert(t, True, tombstone=F.expr(_GONE), tombstone_mode="latest_wins"),
    f"select * from (select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1) where not ({_GONE})")
add("stream_cdc_delete_filter_first", lambda t: _stream_upsert(t, tombstone=F.expr(_GONE)),
    f"select * from events where not ({_GONE}) qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")


def _silences(t):
    """Users that show no event for one day and for three, told while the stream runs: files of a week each, one per trigger."""
    spark = t["events"].sparkSession
    folder = _scratch(spark, "silence") + "/events"
    first, newest = t["events"].agg(F.min("ts"), F.max("ts")).first()
    files = 0
    for k in range(4):
        low, high = (first + (newest - first) * j / 4 for j in (k, k + 1))
        part = t["events"].filter((F.col("ts") >= F.lit(low)) & ((F.col("ts") < F.lit(high)) | F.lit(k == 3)))
        part.write.mode("append").parquet(folder)
        files = max(files, len(spark.read.parquet(folder).inputFiles()) - files)
    stream = spark.readStream.schema(t["events"].schema).option("maxFilesPerTrigger", files).parquet(folder)
    alerts = keyed.silence_alerts(stream, ["user_id"], "ts", {"WARN": timedelta(days=1), "ALERT": timedelta(days=3)}, late="10 days")
    told = keyed.drain_keyed(alerts, folder + "-alerts")
    return told.select("user_id", "level", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("last_seen", "crossed_at")])


add("stream_silence_alerts", _silences,
    """select user_id, level, ts as last_seen, ts + days * interval 1 day as crossed_at from (
 select distinct user_id, ts, lead(ts) over (partition by user_id order by ts) as next from (select distinct user_id, ts from events)),
 (values ('WARN', 1), ('ALERT', 3)) as l(level, days), (select date_trunc('milliseconds', max(ts)) - interval 10 day as mark from events)
 where (next is null or next > ts + days * interval 1 day) and ts + days * interval 1 day < mark""")


def _stream_distinct(t):
    _, stream, folder = _event_stream(t)
    stamped = stream.withColumn("at", F.col("ts").cast("timestamp"))
    rows = live.drain(live.exact_daily_distinct(stamped, "at", "user_id", "40 days"), folder + "-users", "append")
    return rows.groupBy("sale_date").agg(F.count(F.lit(1)).alias("users"))


add("stream_daily_distinct", _stream_distinct, "select cast(ts as date) as sale_date, count(distinct user_id) as users from events group by 1")


def _stream_ages(t):
    _, stream, folder = _event_stream(t)
    return live.drain(live.stream_ages(stream, ["event_type"], "ts"), folder + "-ages", "complete")


add("stream_freshness", _stream_ages, "select event_type, max(ts) as last_extracted_at, count(*) as records from events group by 1")


def _stream_approx(t):
    """The approximate count is compared as a statement about its error: within 10 % of the exact one."""
    _, stream, folder = _event_stream(t)
    stamped = stream.withColumn("at", F.col("ts").cast("timestamp"))
    rows = live.drain(live.daily_distinct(stamped, "at", "user_id"), folder + "-approx", "complete")
    exact = t["events"].groupBy(F.col("ts").cast("date").alias("sale_date")).agg(F.count_distinct("user_id").alias("exact"))
    near = F.abs(F.col("orders") - F.col("exact")) <= 0.1 * F.col("exact")
    return rows.join(exact, "sale_date").select("sale_date", "records", near.alias("within_error"))


add("stream_daily_approximate", _stream_approx, "select cast(ts as date) as sale_date, count(*) as records, true as within_error from events group by 1")


def _archive_rerun(t):
    """The second run with one stamp archives nothing again."""
    root = _scratch(t["orders"].sparkSession, "archive")
    spark = t["orders"].sparkSession
    rows = t["orders"].groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("v")).withColumn("kind", F.lit("priority"))
    for at in ("2001-01-01", "2001-02-01", "2001-02-01"):
        sinks.archive_then_overwrite(spark, f"{root}/current", f"{root}/history", rows, "kind", "priority", at)
    return sinks.read_table(spark, f"{root}/history").select("o_orderpriority", "v", F.col("kind").cast("string"), F.date_format("archived_at", "yyyy-MM-dd").alias("at"))


add("archive_rerun", _archive_rerun, "select o_orderpriority, sum(o_totalprice) as v, 'priority' as kind, '2001-02-01' as at from orders group by 1", {"v": 2})


def _merge_months(t):
    """Two-digit months as folders: 01 stays text and meets its own folder; some keys are null."""
    spark = t["orders"].sparkSession
    path = _scratch(spark, "merge") + "/months"
    rows = t["orders"].select(F.expr("nullif(o_orderkey, 1)").alias("o_orderkey"), "o_totalprice", F.date_format("o_orderdate", "MM").alias("mm"))
    sinks.merge_by_key(spark, path, rows, ["o_orderkey"], "mm")
    moved = rows.filter("mm = '01' or o_orderkey is null").withColumns({"mm": F.lit("x:" + "1"), "o_totalprice": F.col("o_totalprice") + 1})
    for _ in range(2):
        sinks.merge_by_key(spark, path, moved, ["o_orderkey"], "mm")
    return sinks.read_merged(spark, path, rows, "mm")


add("merge_by_month", _merge_months,
    """select nullif(o_orderkey, 1) as o_orderkey, case when m then o_totalprice + 1 else o_totalprice end as o_totalprice, case when m then 'x:1' else mm end as mm
 from (select o_orderkey, o_totalprice, strftime(o_orderdate, '%m') as mm, strftime(o_orderdate, '%m') = '01' or o_orderkey = 1 as m from orders)""", {"o_totalprice": 2})


# --- sources: files written from the given tables and read back ------------------------------
def _landing(t):
    spark = t["orders"].sparkSession
    root = _scratch(spark, "landing")
    t["orders"].write.parquet(f"{root}/fishbowl/so")
    t["customer"].write.parquet(f"{root}/magento/customer_entity")
    found = readers.read_landing(spark, root + "/", ["fishbowl.so", "magento.customer_entity"])
    return found["fishbowl.so"].join(found["magento.customer_entity"].select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")


add("source_landing", _landing, "select o.*, c_name from orders o join customer on c_custkey = o_custkey")


def _invoices(t):
    folder = _scratch(t["lineitem"].sparkSession, "invoices")
    rows = t["lineitem"].select(F.concat(F.lit("T"), F.col("l_orderkey") % 500).alias("tracking_number"), F.col("l_tax").alias("net_amount"))
    rows.write.option("header", True).csv(folder)
    read = readers.read_invoices(t["lineitem"].sparkSession, folder)
    return read.groupBy("tracking_number").agg(F.sum("net_amount").alias("net_amount"), F.count(F.lit(1)).alias("lines"))


add("source_invoice_csv", _invoices,
    "select 'T' || (l_orderkey % 500) as tracking_number, sum(l_tax) as net_amount, count(*) as lines from lineitem group by 1", {"net_amount": 4})


def _seed(t):
    folder = _scratch(t["nation"].sparkSession, "seed")
    t["nation"].select(F.col("n_nationkey").alias("customer_group_id"), F.col("n_name").alias("customer_group_code")).write.option("header", True).csv(folder)
    return readers.read_seed(t["nation"].sparkSession, folder)


add("source_seed_csv", _seed, "select cast(n_nationkey as int) as customer_group_id, n_name as customer_group_code from nation")


def _dated(t):
    """Change files laid out by year and month, read through a pattern: the first half of each year only."""
    spark = t["orders"].sparkSession
    root = _scratch(spark, "dated")
    dated = t["orders"].select("*", F.date_format("o_orderdate", "yyyy").alias("y"), F.date_format("o_orderdate", "MM").alias("m"))
    dated.write.partitionBy("y", "m").parquet(root)
    return readers.read_cdc_files(spark, f"{root}/y=*/m=0[1-6]", t["orders"].schema)


add("source_dated_files", _dated, "select * from orders where month(o_orderdate) <= 6")
