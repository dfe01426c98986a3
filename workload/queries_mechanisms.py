"""Interval joins, parity by digests, mergeable sketches, variants, bucketed tables, forecasts chosen by backtest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stocktally.functions import variants
from stocktally.operators import joins, parity, sketches
from stocktally.plans import build, smoothing
from stocktally.session import shared_folder
from stocktally.sources.tables import Tables
from workload.registry import add


def _scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- interval join: each supplier has a window of one to three days -----------------------------
def _windows(t):
    low = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("s_suppkey") % 29, F.col("s_nationkey"))
    return t["supplier"].select("s_suppkey", low.alias("low"), (low + F.make_dt_interval(1 + F.col("s_suppkey") % 3)).alias("high"))


_WINDOWS = """(select s_suppkey, low, low + (1 + s_suppkey % 3) * interval 1 day as high from (
 select s_suppkey, timestamp '2024-01-01' + (s_suppkey % 29) * interval 1 day + s_nationkey * interval 1 hour as low from supplier))"""


def events_in_windows(t):
    held = joins.interval_join(t["events"].select("ts", "value"), "ts", _windows(t), "low", "high")
    return held.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))


add("interval_join_events", events_in_windows,
    f"select s_suppkey, count(*) as events, sum(value) as value from events join {_WINDOWS} on ts >= low and ts < high group by 1", "value")
add("interval_join_numbers", lambda t: joins.interval_join(
    t["customer"].select("c_custkey", "c_acctbal"), "c_acctbal",
    t["nation"].select("n_nationkey", (F.col("n_nationkey") * 450.5 - 1000).alias("low"), (F.col("n_nationkey") * 450.5 - 1000 + F.pow(F.lit(2.0), F.col("n_nationkey") % 9)).alias("high")),
    "low", "high", "left", "both").select("c_custkey", "n_nationkey"),
    """select c_custkey, n_nationkey from customer left join (select n_nationkey, n_nationkey * 450.5 - 1000 as low, n_nationkey * 450.5 - 1000 + power(2.0, n_nationkey % 9) as high from nation)
 on c_acctbal between low and high""")


# --- parity: a copy of the orders with other prices, lost rows and rows of its own -----------------
def _parity(t):
    left = t["orders"].select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    day = F.day("o_orderdate")
    right = left.filter(F.month("o_orderdate") != 2).withColumn("o_totalprice", F.when(day == 3, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")))
    own = left.filter(day == 4).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return parity.digest_parity(left, right.unionByName(own), ["o_orderkey"], fan_out=64)


add("parity_by_digest", _parity,
    """select o_orderkey, 1 as left_rows, 0 as right_rows, 'left_only' as state from orders where month(o_orderdate) = 2
 union all select o_orderkey, 1, 1, 'changed' from orders where month(o_orderdate) <> 2 and day(o_orderdate) = 3
 union all select -o_orderkey - 1, 0, 1, 'right_only' from orders where day(o_orderdate) = 4""")
add("parity_of_equal_copies", lambda t: parity.digest_parity(t["lineitem"], t["lineitem"].repartition(5, "l_partkey"), ["l_orderkey", "l_linenumber"]),
    "select l_orderkey, l_linenumber, 0 as left_rows, 0 as right_rows, '' as state from lineitem where false")


# --- sketches stored per day and product beside f_sales -------------------------------------------------
def _sketched(t, unit):
    """Two loads, of which the second repeats a month; counts of any span lie within the stated error of the exact ones."""
    spark = t["orders"].sparkSession
    path = _scratch(spark, "sketches") + "/orders"
    sales = t["f_sales"].select("created_at", F.col("product_id").alias("sku"), F.col("order_id").cast("string").alias("order_id"))
    for part in (F.col("created_at") < "2000-02-01", F.col("created_at") >= "2000-01-01"):
        sketches.store_sketches(spark, path, sketches.daily_sketches(sales.filter(part), F.col("created_at"), "order_id", ["sku"]), ["sku"])
    period = lambda c: F.trunc(c, unit).alias("period")
    merged = sketches.distinct_over(sketches.stored_sketches(spark, path).filter(F.col("day").isNotNull()), [period("day")])
    exact = sales.filter(F.col("created_at").isNotNull()).groupBy(period("created_at")).agg(F.count_distinct("order_id").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(sketches.ERROR * F.col("exact"), F.lit(0.5))
    return merged.join(exact, "period").select("period", "records", near.alias("within_error"))


for _unit in ("week", "month"):
    add(f"sketch_distinct_by_{_unit}", lambda t, u=_unit: _sketched(t, u),
        f"select cast(date_trunc('{_unit}', created_at) as date) as period, count(*) as records, true as within_error from {{f_sales}} where created_at is not null group by 1")


# --- variants: JSON text parsed once, stored with typed columns -------------------------------------
def _shredded(t):
    spark = t["events"].sparkSession
    path = _scratch(spark, "variants") + "/events"
    paths = {"k": ("$.k", "int"), "k_text": ("$.k", "string"), "missing": ("$.a.b", "string")}
    variants.shred(t["events"].select("event_id", "props"), "props", paths, "document").write.parquet(path)
    stored = spark.read.parquet(path)
    return stored.select("event_id", "k", "k_text", "missing", variants.path_of("document", "$.k", "double").alias("again"))


add("variant_paths", _shredded,
    """select event_id, cast(json_extract_string(props, '$.k') as int) as k, json_extract_string(props, '$.k') as k_text, json_extract_string(props, '$.a.b') as missing,
 cast(json_extract_string(props, '$.k') as double) as again from events""")


# --- bucketed tables ----------------------------------------------------------------------------------
def bucketed_sales(t):
    """f_sales with its order freight, both stored in buckets of the order."""
    spark = t["orders"].sparkSession
    mark = uuid.uuid4().hex
    own = Tables({}, {n: t[n] for n in ("f_sales", "int_magento_order_freight")})
    build.lay_out(own, 8, ("f_sales", "int_magento_order_freight"), f"laid_{mark}_", _scratch(spark, "laid"))
    freight = own["int_magento_order_freight"].select("order_id", "shipping_amount")
    return own["f_sales"].join(freight.hint("merge"), "order_id").groupBy("order_id").agg(F.count(F.lit(1)).alias("items"), F.sum("shipping_amount").alias("shipping"))


add("join_of_bucketed_tables", bucketed_sales,
    "select s.order_id, count(*) as items, sum(f.shipping_amount) as shipping from {f_sales} s join {int_magento_order_freight} f on f.order_id = s.order_id group by 1", "shipping")


# --- smoothing with rates chosen by rolling origins ---------------------------------------------------
def smoothing_sql(series: str, key: str, day: str, y: str, horizon: int, origins: int, stride: int) -> str:
    """The same fold as a recursive statement: one step a day, for all series and rates at once."""
    grid = ", ".join(f"({p}, {a}::double, {b}::double, {g}::double)" for p, (a, b, g) in enumerate(smoothing.GRID))
    ahead = "greatest(lvl + s * tr + se[(s - 1) % 7 + 1], 0)"
    return f"""with recursive sums as (select {key} as g0, {day} as day, sum({y}) as y from {series} group by 1, 2),
 spans as (select g0, min(day) as f, max(day) as l from sums group by 1),
 dense as (select s.g0, d::date as day, coalesce(x.y, 0.0) as y, row_number() over (partition by s.g0 order by d) as i
  from (select g0, unnest(generate_series(f::timestamp, l::timestamp, interval 1 day)) as d from spans) s left join sums x on x.g0 = s.g0 and x.day = s.d::date),
 arr as (select g0, count(*) as n, list(y order by i) as ys from dense group by 1),
 grid(p, a, b, g) as (values {grid}),
 fold(g0, p, i, lvl, tr, se) as (
  select g0, p, 7::bigint, list_avg(ys[1:7]), (list_avg(ys[8:14]) - list_avg(ys[1:7])) / 7, list_transform(ys[1:7], lambda v: v - list_avg(ys[1:7])) from arr, grid where n >= 14
  union all
  select g0, p, i + 1, nl, b * (nl - lvl) + (1 - b) * tr, list_concat(se[2:7], [g * (v - nl) + (1 - g) * se[1]])
  from (select f.*, a, b, g, d.y as v, a * (d.y - se[1]) + (1 - a) * (lvl + tr) as nl from fold f join dense d on d.g0 = f.g0 and d.i = f.i + 1 join grid using (p))),
 losses as (select f.g0, p, sum(abs(ys[f.i + s] - {ahead})) as loss from fold f join arr using (g0), range(1, {horizon} + 1) r(s), range({origins}) o(k)
  where f.i = n - {horizon} - k * {stride} and f.i >= 14 group by 1, 2),
 best as (select g0, p from (select c.g0, c.p, row_number() over (partition by c.g0 order by round(coalesce(loss, 0), 6), c.p) as r
  from (select distinct g0, p from fold) c left join losses l on l.g0 = c.g0 and l.p = c.p) where r = 1)
 select g0 as {key}, (f + (n + s - 1)::int)::date as forecast_date, {ahead} as predicted_units, a, b, g
 from fold join best using (g0, p) join arr using (g0) join spans using (g0) join grid using (p), range(1, {horizon} + 1) r(s) where fold.i = n"""


_PRIORITY = "(select o_orderpriority, cast(o_orderdate as date) as day, sum(o_totalprice) as y from orders group by 1, 2)"


def _daily(t):
    return t["orders"].groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias("day")).agg(F.sum("o_totalprice").alias("y"))


add("forecast_smoothed", lambda t: smoothing.smooth_forecast(_daily(t), ["o_orderpriority"], "day", "y", 14, 4),
    smoothing_sql(_PRIORITY, "o_orderpriority", "day", "y", 14, 4, 30), {"predicted_units": 2, "a": 3, "b": 3, "g": 3})
add("forecast_smoothed_backtest", lambda t: smoothing.smooth_backtest(_daily(t), ["o_orderpriority"], "day", "y", "2001-03-15"),
    f"""select d.o_orderpriority, avg(abs(d.y - predicted_units) / d.y * 100) as mape, count(*) as days from {_PRIORITY} d
 join ({smoothing_sql(f"(select * from {_PRIORITY} where day <= date '2001-03-15')", 'o_orderpriority', 'day', 'y', 60, 6, 30)}) f
 on f.o_orderpriority = d.o_orderpriority and forecast_date = d.day where d.day > date '2001-03-15' and d.day <= date '2001-03-15' + 30 and d.y > 0 group by 1""", "mape")


def _coverage(t):
    """Bounds at 90 % from errors before each of three cutoffs: the share of the next days inside lies near the level."""
    key, inside = ["o_orderpriority"], None
    for cutoff in ("2000-11-30", "2001-02-28", "2001-05-31"):
        day = F.col("day")
        past = _daily(t).filter(day <= F.lit(cutoff).cast("date"))
        made = smoothing.smooth_forecast(past, key, "day", "y", 28)
        after = F.datediff("forecast_date", F.lit(cutoff).cast("date"))
        bounded = smoothing.with_bounds(made.filter(after > 0), smoothing.residual_sketches(past, key, "day", "y", 35, 40), key, after, 0.9)
        actual = _daily(t).filter((day > F.lit(cutoff).cast("date"))).select("o_orderpriority", day.alias("forecast_date"), "y")
        days = bounded.join(actual, ["o_orderpriority", "forecast_date"], "left").select(F.coalesce("y", F.lit(0.0)).between(F.col("lower_bound"), F.col("upper_bound")).alias("inside"))
        inside = days if inside is None else inside.unionByName(days)
    return inside.agg((F.abs(F.avg(F.col("inside").cast("double")) - 0.9) <= 0.1).alias("near_level"))


add("forecast_bounds_coverage", _coverage, "select true as near_level from orders limit 1")
