"""Forecasts, dashboard analytics, business questions, usage cost, freshness, quality."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from stocktally.functions.scalars import ZIP3_STATES
from stocktally.operators import history
from stocktally.plans import bi, forecast, metrics, purchasing
from stocktally.sources.tables import Tables
from workload.oracle_models import M, segmentation_sql
from workload.registry import add
from workload.tables import AS_OF, CFG

# --- forecasts ---------------------------------------------------------------------
_Z95, _Z99 = NormalDist().inv_cdf(0.975), NormalDist().inv_cdf(0.995)


def fit_sql(source: str, series: str, day: str, y: str) -> str:
    """Trend, weekday effect and spread by direct regression, one row per series and weekday."""
    return f"""(with h as (select {series} as g, cast({day} as date) as d, datediff('day', date '2000-01-01', cast({day} as date)) as x, cast({y} as double) as y
 from {source} where {y} is not null), line as (select g, coalesce(regr_slope(y, x), 0) as b, avg(y) - coalesce(regr_slope(y, x), 0) * avg(x) as a, max(d) as last_day, count(*) as n from h group by 1),
 res as (select h.g, isodow(d) - 1 as w, y - a - b * x as e from h join line using (g)), eff as (select g, w, avg(e) as m from res group by 1, 2),
 spread as (select g, sqrt(sum((e - m) * (e - m)) / greatest(count(*) - 1, 1)) as sigma from res join eff using (g, w) group by 1)
 select line.*, sigma, w, m from line join spread using (g) join (select g, unnest(range(7)) as w from line) using (g) left join eff using (g, w))"""


def forecast_sql(source: str, series: str, day: str, y: str, horizon: int = 30, z: float = _Z95) -> str:
    return f"""select g as {series}, forecast_date, p as predicted_units, p - {z} * sigma as lower_bound, p + {z} * sigma as upper_bound from (
 select f.g, s.forecast_date, a + b * datediff('day', date '2000-01-01', s.forecast_date) + coalesce(m, 0) as p, sigma from {fit_sql(source, series, day, y)} f
 join (select g, cast(unnest(range(last_day + 1, last_day + {horizon + 1}, interval 1 day)) as date) as forecast_date from (select distinct g, last_day from {fit_sql(source, series, day, y)}))
 s on s.g = f.g and isodow(s.forecast_date) - 1 = f.w)"""


_BANDS = "predicted_units lower_bound upper_bound"


def _order_series(t: Tables):
    return t["orders"].groupBy("o_orderpriority", F.col("o_orderdate").cast("date").alias("day")).agg(F.sum("o_totalprice").alias("y"))


_SERIES = "(select o_orderpriority, cast(o_orderdate as date) as day, sum(o_totalprice) as y from orders group by 1, 2)"
add("forecast_order_series", lambda t: forecast.forecast(_order_series(t), ["o_orderpriority"], "day", "y"),
    forecast_sql(_SERIES, "o_orderpriority", "day", "y"), {c: 2 for c in _BANDS.split()})

M["caliber_history"] = f"select * from {{int_daily_sales_by_caliber}} where sale_date <= date '{AS_OF}'"
M["f_forecast"] = f"""select caliber, forecast_date, cast(predicted_units as decimal(18, 4)) as predicted_units, cast(lower_bound as decimal(18, 4)) as lower_bound,
 cast(upper_bound as decimal(18, 4)) as upper_bound, 'caliber' as forecast_type, timestamp '{AS_OF}' as trained_at from ({forecast_sql('{caliber_history}', 'caliber', 'sale_date', 'units_sold')})"""


def _with_forecast(t: Tables) -> Tables:
    past = t["int_daily_sales_by_caliber"].filter(F.col("sale_date") <= F.lit(AS_OF).cast("date"))
    predicted = forecast.forecast(past, ["caliber"], "sale_date", "units_sold")
    return t.extended({"f_forecast": lambda _: forecast.forecast_table(predicted, "caliber", "caliber", AS_OF)})


add("f_forecast", lambda t: _with_forecast(t)["f_forecast"], "select * from {f_forecast}", {c: 3 for c in _BANDS.split()})
add("f_forecast_revenue", lambda t: forecast.revenue_forecast(t["v_daily_revenue"], AS_OF),
    f"""select 'REVENUE' as caliber, forecast_date, predicted_units, lower_bound, upper_bound, 'revenue' as forecast_type, timestamp '{AS_OF}' as trained_at
 from ({forecast_sql("(select 'REVENUE' as g0, * from {v_daily_revenue})", 'g0', 'sale_date', 'total_revenue')})""", {c: 2 for c in _BANDS.split()})


def anomalies_sql(source: str, y: str, name: str) -> str:
    cut = f"date '{AS_OF}' - 30"
    return f"""select '{name}' as metric_name, sale_date as anomaly_date, cast({y} as double) as actual_value, e as expected_value,
 coalesce(abs(dist) > {_Z99}, false) as is_anomaly, dist as distance from (select d.*, e, (cast({y} as double) - e) / nullif(sigma, 0) as dist from (
 select d.*, sigma, a + b * datediff('day', date '2000-01-01', d.sale_date) + coalesce(m, 0) as e from {source} d join {fit_sql(f"(select 'x' as k, * from {source} where sale_date < {cut})", 'k', 'sale_date', y)} f
 on isodow(d.sale_date) - 1 = f.w where d.sale_date >= {cut}) d)"""


M["anomaly_rows"] = " union all ".join(anomalies_sql("{int_daily_sales_metrics}", y, n) for n, y in (("revenue", "daily_revenue"), ("orders", "daily_orders"), ("margin", "daily_margin_pct")))
_ANOM = {"actual_value": 2, "expected_value": 2, "distance": 4}
add("f_anomalies", lambda t: forecast.metric_anomalies(t["int_daily_sales_metrics"], AS_OF).drop("percentile"), "select * from {anomaly_rows}", _ANOM)
add("anomaly_percentiles", lambda t: forecast.metric_anomalies(t["int_daily_sales_metrics"], AS_OF).filter(F.col("percentile") > 0.9).select("metric_name", "anomaly_date"),
    f"select metric_name, anomaly_date from {{anomaly_rows}} where distance > {NormalDist().inv_cdf(0.9)}")
add("recent_anomalies", lambda t: bi.recent_anomalies(forecast.metric_anomalies(t["int_daily_sales_metrics"], AS_OF), AS_OF).drop("actual_value", "expected_value"),
    f"""select anomaly_date, metric_name, round((actual_value - expected_value) / nullif(expected_value, 0) * 100, 1) as deviation_pct
 from {{anomaly_rows}} where is_anomaly and anomaly_date >= date '{AS_OF}' - 7""")
add("forecast_backtest", lambda t: forecast.backtest(_order_series(t), ["o_orderpriority"], "day", "y", "2001-03-15", 30),
    f"""select d.o_orderpriority, avg(abs(y - (a + b * datediff('day', date '2000-01-01', d.day) + coalesce(m, 0))) / y * 100) as mape, count(*) as days
 from {_SERIES} d join {fit_sql(f"(select * from {_SERIES} where day <= date '2001-03-15')", 'o_orderpriority', 'day', 'y')} f on f.g = d.o_orderpriority and isodow(d.day) - 1 = f.w
 where d.day > date '2001-03-15' and d.day <= date '2001-03-15' + 30 and y > 0 group by 1""", "mape")


def _archived(t: Tables):
    """Two archived runs per day; the later one must lose."""
    base = t["int_daily_sales_by_caliber"].select("caliber", F.col("sale_date").alias("forecast_date"), F.col("units_sold").alias("u"))
    def run(scale, stamp):
        p = F.col("u") * scale + 3
        return base.select("caliber", "forecast_date", p.alias("predicted_units"), (p - 10).alias("lower_bound"), (p + 10).alias("upper_bound"), F.lit(stamp).cast("timestamp").alias("archived_at"))
    return run(0.9, "2001-01-01").unionByName(run(2.0, "2001-02-01"))


add("forecast_accuracy", lambda t: forecast.forecast_accuracy(
    t["int_daily_sales_by_caliber"].filter(F.col("sale_date") >= F.date_sub(F.lit(AS_OF).cast("date"), 30)).select("caliber", "sale_date", "units_sold"), _archived(t), "caliber", "sale_date", "units_sold"),
    f"""select caliber, count(*) as matched_days, round(avg(abs(u - p)), 1) as mae, round(avg(abs(u - p) / nullif(u, 0)) * 100, 1) as mape, round(avg(u - p), 1) as bias,
 count(*) filter (u between p - 10 and p + 10) as within_band, round(count(*) filter (u between p - 10 and p + 10) / count(*) * 100, 1) as coverage_pct
 from (select caliber, units_sold as u, units_sold * 0.9 + 3 as p from {{int_daily_sales_by_caliber}} where sale_date >= date '{AS_OF}' - 30) group by 1 having count(*) >= 7""")

M["stock_by_caliber"] = """select p.caliber, sum(i.qty_available) as qty_available, sum(i.qty_on_order) as qty_on_order, sum(i.extended_cost) as inventory_value
 from {f_inventoryview} i join {int_product_analyst} p on p.sku = i.part_number where p.caliber <> '' group by 1"""
M["demand_by_caliber"] = f"""select caliber, sum(predicted_units) as demand_30d, sum(upper_bound) as demand_upper_30d, avg(predicted_units) as daily_avg_predicted from {{f_forecast}}
 where forecast_date > date '{AS_OF}' and forecast_date <= date '{AS_OF}' + 30 group by 1"""
M["vendor_by_caliber"] = """select p.caliber, f.vendor_id, round(avg(f.precise_leadtime), 0) as avg_lead_time, avg(f.unit_cost) as avg_unit_cost from {f_pos} f
 join {int_product_analyst} p on p.sku = f.part_number where f.precise_leadtime is not null and f.vendor_id is not null and p.caliber <> '' group by 1, 2"""
M["f_reorder_recommendations"] = f"""with b as (select d.caliber, coalesce(s.qty_available, 0) as qty_available, coalesce(s.qty_on_order, 0) as qty_on_order, round(cast(d.demand_upper_30d as double), 0) as need,
  d.daily_avg_predicted as daily, coalesce(v.avg_lead_time, 14) as lead, v.vendor_id, coalesce(v.avg_unit_cost, 0) as unit from {{demand_by_caliber}} d
  left join {{stock_by_caliber}} s using (caliber) left join (select *, row_number() over (partition by caliber order by avg_lead_time, vendor_id) as r from {{vendor_by_caliber}}) v
  on v.caliber = d.caliber and v.r = 1),
 c as (select *, greatest(0, need - qty_available - qty_on_order) as reorder_qty, case when daily > 0 then round(qty_available / daily, 1) end as dos from b)
 select vendor_id as recommended_vendor_id, caliber, qty_available, qty_on_order, need as demand_upper_30d, round(daily, 1) as daily_avg_predicted, lead as lead_time_days, unit as avg_unit_cost,
  reorder_qty, dos as days_of_supply, case when daily > 0 then date '{AS_OF}' + cast(greatest(round(qty_available / daily) - lead, 0) as int) end as reorder_by,
  case when dos <= lead then 'Critical' when dos <= lead * 2 then 'Warning' when dos > 90 then 'Overstock' else 'OK' end as urgency,
  case when reorder_qty > 0 then round(reorder_qty * unit, 2) else 0 end as estimated_order_cost, s_name as recommended_vendor, timestamp '{AS_OF}' as refreshed_at
 from c left join supplier on s_suppkey = vendor_id"""
_REORDER = {"qty_available": 2, "qty_on_order": 2, "demand_upper_30d": 0, "daily_avg_predicted": 1, "avg_unit_cost": 3, "reorder_qty": 2, "days_of_supply": 1, "estimated_order_cost": 0}
add("f_reorder_recommendations", lambda t: purchasing.reorder_recommendations(_with_forecast(t), AS_OF, CFG), "select * from {f_reorder_recommendations}", _REORDER)
add("reorder_list", lambda t: bi.reorder_list(purchasing.reorder_recommendations(_with_forecast(t), AS_OF, CFG)).select("caliber", "urgency", "recommended_vendor"),
    "select caliber, urgency, recommended_vendor from {f_reorder_recommendations}")
add("stockout_risk", lambda t: purchasing.caliber_stockout_risk(_with_forecast(t), AS_OF, CFG),
    f"""select s.caliber, s.qty_available as qty_on_hand, s.qty_on_order, round(s.inventory_value, 2) as inventory_value, round(cast(d.demand_30d as double), 0) as demand_30d,
 round(d.daily_avg_predicted, 1) as daily_avg_predicted, case when d.daily_avg_predicted > 0 then round(s.qty_available / d.daily_avg_predicted, 1) end as days_of_supply,
 coalesce(l.lead, 14) as lead_time_days, case when d.daily_avg_predicted > 0 then date '{AS_OF}' + cast(greatest(round(s.qty_available / d.daily_avg_predicted) - coalesce(l.lead, 14), 0) as int) end as reorder_by,
 case when d.daily_avg_predicted > 0 then case when s.qty_available / d.daily_avg_predicted <= coalesce(l.lead, 14) then 'Critical'
  when s.qty_available / d.daily_avg_predicted <= coalesce(l.lead, 14) * 2 then 'Warning' when s.qty_available / d.daily_avg_predicted > 90 then 'Overstock' else 'OK' end else 'OK' end as risk_level
 from {{stock_by_caliber}} s left join {{demand_by_caliber}} d using (caliber) left join (select p.caliber, round(avg(f.precise_leadtime), 0) as lead from {{f_pos}} f
 join {{int_product_analyst}} p on p.sku = f.part_number where f.precise_leadtime is not null group by 1) l using (caliber) where s.qty_available > 0""",
    {"qty_on_hand": 2, "qty_on_order": 2, "inventory_value": 1, "demand_30d": 0, "daily_avg_predicted": 1, "days_of_supply": 1})


def _projection(t: Tables):
    stock = t["fishbowl_tag"].groupBy("part_id").agg(F.sum("quantity_on_tag").alias("qty"))
    rate = t["magento_sales_order_item"].groupBy(F.col("product_id").alias("part_id")).agg((F.sum("quantity_ordered") / 365).alias("rate"))
    coming = t["f_pos"].filter(F.col("date_expected") >= AS_OF).select("part_id", F.col("date_expected").cast("date").alias("day"), "qty")
    return forecast.project_inventory(stock, coming, rate, ["part_id"], AS_OF, "2001-07-15")


add("project_inventory", _projection,
    f"""with days as (select cast(unnest(range(date '{AS_OF}', date '2001-07-16', interval 1 day)) as date) as day),
 s as (select part_id, sum(quantity_on_tag) as q from {{fishbowl_tag}} group by 1), r as (select product_id as part_id, sum(quantity_ordered) / 365 as rate from {{magento_sales_order_item}} group by 1),
 a as (select part_id, cast(date_expected as date) as day, sum(qty) as arrived from {{f_pos}} where date_expected >= timestamp '{AS_OF}' group by 1, 2),
 g as (select s.part_id, d.day, coalesce(a.arrived, 0) as arrived, s.q + sum(coalesce(a.arrived, 0)) over w - coalesce(r.rate, 0) * count(*) over w as p
  from s cross join days d left join a on a.part_id = s.part_id and a.day = d.day left join r on r.part_id = s.part_id window w as (partition by s.part_id order by d.day))
 select part_id, day, arrived, greatest(p, 0) as projected_qty, min(case when p <= 0 then day end) over (partition by part_id) as stockout_date from g""", "arrived projected_qty")

# --- dashboard -----------------------------------------------------------------------
_START, _END = "2000-07-01", AS_OF
M["facts"] = f"""select s.*, hour(s.timedate) as hour_num, s.increment_id as order_no, cast(round(s.part_qty_sold) as int) as units, p.vendor as product_vendor, p.attribute_set as category,
 p.manufacturer, coalesce(p.dd_caliber, p.caliber) as caliber, p.manufacturer_sku, p.product_name, p.use_type_category, p.primary_category
 from {{active_sales}} s left join {{d_product}} p using (product_id) where s.created_at between date '{_START}' and date '{_END}'"""


def _facts(t: Tables):
    return bi.sales_facts(t, _START, _END, cfg=CFG)


def _measure(metric: str) -> str:
    return {"$": "sum(row_total)", "GP ($)": "sum(row_total) - sum(cost)", "Orders": "count(distinct order_no)", "Units": "sum(units)"}[metric]


_MEAS = "sum(row_total) as net_sales, sum(cost) as cost, sum(row_total) - sum(cost) as gp, count(distinct order_no) as orders, sum(units) as units"
add("sales_facts", lambda t: _facts(t).select("created_at", "timedate", "order_id", "product_id", "sku", "net_sales", "cost", "units", "category", "caliber", "manufacturer_sku", "use_type_category"),
    "select created_at, timedate, order_no as order_id, product_id, testsku as sku, row_total as net_sales, cost, units, category, caliber, manufacturer_sku, use_type_category from {facts}", "net_sales cost")
_KPI = f"""select 0 as one, sum(row_total) as net_sales, sum(cost) as cost, sum(row_total) - sum(cost) as gross_profit, count(distinct order_no) as orders, sum(units) as units,
 sum(freight_revenue) as freight_rev, sum(freight_cost) as freight_cost, sum(row_total) - sum(cost) - sum(freight_cost) as gp_after_var,
 (select count(*) from (select order_no from {{facts}} group by 1 having sum(row_total) >= {CFG.free_shipping_threshold})) as free_ship_orders,
 (sum(row_total) - sum(cost)) / sum(row_total) * 100 as margin, sum(row_total) / count(distinct order_no) as avg_ticket, sum(freight_revenue) / sum(row_total) * 100 as shipping_pct,
 (sum(row_total) - sum(cost) - sum(freight_cost)) / sum(row_total) * 100 as contribution_margin from {{facts}}"""
add("kpi_set", lambda t: bi.kpis(_facts(t), CFG), f"select * exclude (one) from ({_KPI})",
    {c: 2 for c in "net_sales cost gross_profit freight_rev freight_cost gp_after_var avg_ticket".split()} | {c: 4 for c in "margin shipping_pct contribution_margin".split()})
_METRICS = (
    "net_sales", "cost", "gross_profit", "orders", "units", "freight_rev", "freight_cost", "gp_after_var", "free_ship_orders", "margin",
    "avg_ticket", "shipping_pct", "contribution_margin",
)


def _within(start, end) -> str:
    return _KPI.replace("{facts}", f"(select * from {{facts}} where created_at between date '{start}' and date '{end}')")


for _kind, _given in (("TODAY", ()), ("MTD", ()), ("YTD", ()), ("CUSTOM", (2001, 3))):
    _p = bi.period(_kind, AS_OF, *_given)
    add(f"compare_{_kind.lower()}", lambda t, p=_p: bi.compare_periods(_facts(t), p, cfg=CFG),
        f"with c as ({_within(_p.start, _p.end)}), v as ({_within(_p.compare_start, _p.compare_end)}) " + " union all ".join(
            f"select '{m}' as metric, cast(coalesce(c.{m}, 0) as double) as current, cast(coalesce(v.{m}, 0) as double) as previous, "
            f"round((coalesce(c.{m}, 0) - v.{m}) / nullif(abs(v.{m}), 0) * 100, 1) as pct_change from c, v" for m in _METRICS
        ), {"current": 2, "previous": 2})
_LABEL = "(case when hour % 12 = 0 then 12 else hour % 12 end) || ':00 ' || case when hour < 12 then 'AM' else 'PM' end as hour_label"
add("hourly_profile", lambda t: bi.hourly_profile(_facts(t), "GP ($)"), f"select *, {_LABEL} from (select hour_num as hour, {_measure('GP ($)')} as value from {{facts}} group by 1)", {"value": 2})
add("hourly_average", lambda t: bi.hourly_average(_facts(t), "Orders"),
    f"select *, {_LABEL} from (select hour_num as hour, avg(v) as value from (select created_at, hour_num, {_measure('Orders')} as v from {{facts}} group by 1, 2) group by 1)", "value")
add("daily_trend", lambda t: bi.daily_trend(_facts(t)),
    f"select *, coalesce(gp / nullif(net_sales, 0) * 100, 0) as margin from (select created_at as day, {_MEAS} from {{facts}} group by 1)", "net_sales cost gp margin")
add("weekday_heatmap", lambda t: bi.weekday_heatmap(_facts(t), "Units"),
    "select isodow(created_at) - 1 as dow_num, dayname(created_at) as dow, " + ", ".join(f"coalesce(sum(units) filter (hour_num = {h}), 0) as h{h:02d}" for h in range(24)) + " from {facts} group by 1, 2")
add("event_heatmap", lambda t: bi.weekday_heatmap(
    t["events"].select(F.col("ts").alias("created_at"), F.hour("ts").alias("hour_num"), F.lit(0).alias("net_sales"), F.lit(0).alias("cost"), F.col("event_id").alias("order_id"), F.lit(1).alias("units")), "Units"),
    "select isodow(ts) - 1 as dow_num, dayname(ts) as dow, " + ", ".join(f"count(*) filter (hour(ts) = {h}) as h{h:02d}" for h in range(24)) + " from events group by 1, 2")
add("top_by_dimension", lambda t: bi.top_by(_facts(t), "category", "$"),
    "select coalesce(category, '(Blank)') as category, sum(row_total) as value from {facts} group by 1 order by value desc nulls last, category limit 8", {"value": 2})
_SKU = f"""select *, coalesce(gp / nullif(net_sales, 0) * 100, 0) as margin, coalesce(net_sales / nullif(units, 0), 0) as per_unit from (
 select coalesce(manufacturer_sku, '(No SKU)') as manufacturer_sku, {_MEAS}, sum(freight_revenue) as s_rev from {{facts}} group by 1) order by net_sales desc nulls last, manufacturer_sku limit 10"""
_SKU_DIGITS = "net_sales cost gp s_rev margin per_unit"


def _sku_pair(t: Tables):
    f = _facts(t)
    return bi.sku_performance(f, f.filter(F.col("created_at") < "2001-01-01"), 10)


add("sku_performance", lambda t: _sku_pair(t)[0],
    f"""select t.*, c.v as net_sales_compare, round((t.net_sales - c.v) / nullif(abs(c.v), 0) * 100, 1) as pct_change from ({_SKU}) t left join (
 select coalesce(manufacturer_sku, '(No SKU)') as manufacturer_sku, sum(row_total) as v from {{facts}} where created_at < date '2001-01-01' group by 1) c using (manufacturer_sku)""", _SKU_DIGITS + " net_sales_compare")
add("sku_performance_detail", lambda t: _sku_pair(t)[1].select("manufacturer_sku", "product_name", "net_sales", "orders", "units", "net_sales_compare"),
    f"""select manufacturer_sku, coalesce(product_name, '(No Name)') as product_name, sum(row_total) as net_sales, count(distinct order_no) as orders, sum(units) as units,
 sum(case when created_at < date '2001-01-01' then row_total end) as net_sales_compare from {{facts}}
 where manufacturer_sku in (select manufacturer_sku from ({_SKU})) group by 1, 2""", "net_sales net_sales_compare")
add("sales_by_city", lambda t: bi.by_city(_facts(t)),
    f"""with c as (select city, {_MEAS} from {{facts}} where city is not null group by 1)
 select city, net_sales, cost, gp, orders, units, round(coalesce(gp / nullif(net_sales, 0) * 100, 0), 2) as margin from c
 union all select 'Total', sum(net_sales), sum(cost), sum(gp), sum(orders), sum(units), round(sum(gp) / sum(net_sales) * 100, 2) from c""", {c: 2 for c in "net_sales cost gp margin".split()})
add("sales_by_state", lambda t: bi.by_state(_facts(t)).select("state", "net_sales", "orders"),
    """select coalesce(region, z.state) as state, sum(row_total) as net_sales, count(distinct order_no) as orders from {facts} f left join (values """
    + ", ".join(f"({lo}, {hi}, '{st}')" for lo, hi, st in ZIP3_STATES)
    + """) as z(lo, hi, state) on cast(substr(f.postcode, 1, 3) as int) between z.lo and z.hi group by 1""", {"net_sales": 2})


def _centroids(t: Tables):
    nation = t["nation"]
    zip3 = F.substring(F.lpad(((F.col("n_nationkey") + 1) * 3947).cast("string"), 5, "0"), 1, 3)
    return nation.select(zip3.alias("zip3"), (F.col("n_nationkey") + 25.5).alias("lat"), (F.col("n_nationkey") - 90.5).alias("lon"))


add("sales_by_zip3", lambda t: bi.by_zip3(_facts(t), _centroids(t)),
    """select f.*, n_nationkey + 25.5 as lat, n_nationkey - 90.5 as lon from (select postcode, substr(postcode, 1, 3) as zip3, city, coalesce(region, (select min(z.state) from (values """
    + ", ".join(f"({lo}, {hi}, '{st}')" for lo, hi, st in ZIP3_STATES)
    + """) as z(lo, hi, state) where cast(substr(postcode, 1, 3) as int) between z.lo and z.hi)) as region, sum(row_total) as net_sales, count(distinct order_no) as orders
 from {facts} group by 1, 2, 3, 4) f join nation on substr(lpad(cast((n_nationkey + 1) * 3947 as varchar), 5, '0'), 1, 3) = zip3""", "net_sales")
_TOPC = f"select customer_email, customer_name, {_MEAS} from {{facts}} group by 1, 2 order by net_sales desc nulls last, customer_email limit 10"
add("top_customers", lambda t: bi.top_customers(_facts(t), 10)[0], f"select * from ({_TOPC})", "net_sales cost gp")
add("top_customer_orders", lambda t: bi.top_customers(_facts(t), 10)[1],
    f"""select customer_email, order_no as order_id, sum(row_total) as net_sales, sum(cost) as cost, sum(units) as units, sum(row_total) - sum(cost) as gp from {{facts}}
 where customer_email in (select customer_email from ({_TOPC})) group by 1, 2""", "net_sales cost gp")
M["supply"] = f"""select i.part_number as sku, qty_available, qty_on_order, part_cost, extended_cost, coalesce(u, 0) as units_sold, coalesce(n, 0) as net_sales, coalesce(c, 0) as cost_of_goods,
 coalesce(u, 0) / 365 as daily_avg, case when u > 0 then qty_available / (u / 365) end as days_of_supply, case when u > 0 then (qty_available + qty_on_order) / (u / 365) end as dos_plus_on_order,
 case when n > 0 then (n - c) / n * 100 else 0 end as pct_margin, qty_on_order * part_cost as cost_on_order,
 case when (select sum(qty_available) from {{f_inventoryview}}) > 0 then qty_available / (select sum(qty_available) from {{f_inventoryview}}) * 100 else 0 end as pct_on_hand
 from {{f_inventoryview}} i left join (select testsku, sum(qty_ordered) as u, sum(row_total) as n, sum(cost) as c from {{facts}} group by 1) s on s.testsku = i.part_number"""


def _supply(t: Tables):
    sold = _facts(t).groupBy("sku").agg(F.sum("qty_ordered").alias("units_sold"), F.sum("net_sales").alias("net_sales"), F.sum("cost").alias("cost_of_goods"))
    stock = t["f_inventoryview"].select(F.col("part_number").alias("sku"), "qty_available", "qty_on_order", "part_cost", "extended_cost")
    return bi.days_of_supply(stock, sold, 365)


_SUP = "qty_available qty_on_order part_cost extended_cost net_sales cost_of_goods daily_avg days_of_supply dos_plus_on_order pct_margin cost_on_order pct_on_hand"
add("days_of_supply", _supply, "select * from {supply}", {c: 3 for c in _SUP.split()})
add("stock_overview", lambda t: bi.stock_overview(_supply(t)).select("sku", "daily_avg"), "select sku, daily_avg from {supply} order by daily_avg desc nulls last, sku limit 50", "daily_avg")
add("low_stock", lambda t: bi.low_stock(_supply(t)).select("sku", "days_of_supply"), "select sku, days_of_supply from {supply} order by days_of_supply asc nulls first, sku limit 50", "days_of_supply")
add("overstock", lambda t: bi.overstock(_supply(t)).select("sku", "days_of_supply"), "select sku, days_of_supply from {supply} order by days_of_supply desc nulls last, sku limit 50", "days_of_supply")
for _dim, _column in (("category", "attribute_set"), ("caliber", "caliber"), ("projectile", "projectile")):
    add(f"stock_by_{_dim}", lambda t, c=_column: bi.stock_breakdown(
        t["f_inventoryview"].select(F.col("part_number").alias("sku"), "extended_cost").join(t["d_product"].select("sku", c), "sku"), c, "extended_cost"),
        f"""select label, value, coalesce(value / nullif(sum(value) over (), 0) * 100, 0) as share from (select {_column} as label, coalesce(sum(extended_cost), 0) as value
 from {{f_inventoryview}} join {{d_product}} on sku = part_number where {_column} is not null group by 1 order by 2 desc, 1 limit 15)""", {"value": 2, "share": 3})
add("monthly_receipts", lambda t: bi.monthly_receipts(t["f_pos"]),
    "select strftime(datereceived, '%Y-%m') as month_key, sum(qty) as qty, avg(unit_cost) as avg_cost from {f_pos} where datereceived is not null and qty <> 0 group by 1", "qty avg_cost")
add("purchase_order_rollup", lambda t: bi.order_rollup(t["f_pos"]),
    """select purchase_order_id, min(po_created_at) as created, min(cast(datereceived as date)) as first_delivery, max(cast(datereceived as date)) as last_delivery, sum(qty) as filled,
 max(quantity_to_fulfill) as total, avg(precise_leadtime) as lead_time, max(date_expected) as expected, count(distinct cast(datereceived as date)) as deliveries,
 case when max(quantity_to_fulfill) > 0 then sum(qty) / max(quantity_to_fulfill) * 100 else 0 end as fill_pct from {f_pos} where datereceived is not null group by 1""", "filled total lead_time fill_pct")
M["vendor_groups"] = """select cast(vendor_id as varchar) as label, sum(qty) as qty, sum(total_cost) as total_cost, count(distinct purchase_order_id) as deliveries, avg(precise_leadtime) as lead_time
 from {f_pos} where vendor_id is not null group by 1"""
add("purchase_breakdown", lambda t: bi.breakdown(t["f_pos"], "vendor_id", 8),
    """(select *, round(total_cost / nullif(qty, 0), 2) as w_avg_cost from {vendor_groups} order by qty desc, label limit 8) union all
 (select 'Total', sum(qty), sum(total_cost), sum(deliveries), avg(lead_time), sum(total_cost) / sum(qty) from {vendor_groups})""", {"qty": 2, "total_cost": 2, "lead_time": 3, "w_avg_cost": 2})
add("open_orders", lambda t: bi.open_orders(t["f_pos"], AS_OF).select("purchase_order_id", "expected", "qty", "filled", "total", "fill_pct", "po_status"),
    f"""select purchase_order_id, max(date_expected) as expected, sum(qty) as qty, sum(quantity_fulfilled) as filled, sum(quantity_to_fulfill) as total,
 case when sum(quantity_to_fulfill) > 0 then sum(quantity_fulfilled) / sum(quantity_to_fulfill) * 100 else 0 end as fill_pct,
 case when max(date_expected) < date '{AS_OF}' then 'OVERDUE' else 'REGULAR' end as po_status from {{f_pos}} where datereceived is null and quantity_to_fulfill > 0 group by 1""", "qty filled total fill_pct")
add("vendor_comparison", lambda t: bi.vendor_comparison(t, "PROMO"),
    """select s_name as vendor_name, round(avg(precise_leadtime), 0) as avg_lead_time_days, round(avg(unit_cost), 3) as avg_unit_cost, count(distinct purchase_order_id) as historical_pos,
 max(datereceived) as last_supplied from {f_pos} f join {int_product_analyst} p on p.sku = f.part_number join supplier on s_suppkey = vendor_id
 where p.caliber = 'PROMO' and precise_leadtime is not null group by 1 order by 2, 1 limit 5""")
add("segment_summary", lambda t: bi.segment_summary(t["d_customer_segmentation"]),
    """select customer_classification, count(*) as customer_count, coalesce(sum(total_revenue), 0) as total_ltv, coalesce(round(avg(days_since_last_purchase), 0), 0) as avg_days_silent,
 coalesce(round(avg(number_of_purchases), 1), 0) as avg_purchases from {d_customer_segmentation} group by 1""", {"total_ltv": 2})
add("top_at_risk", lambda t: bi.top_at_risk(t["d_customer_segmentation"]).select("rank_id", "customer_classification", "total_revenue"),
    """select rank_id, customer_classification, total_revenue from {d_customer_segmentation} where customer_classification in
 ('At-Risk Regular', 'Inactive Regular', 'Lost Buyer', 'Lapsed Buyer', 'Losing 1-Time Buyer', 'Inactive') and total_revenue is not null order by total_revenue desc, rank_id limit 10""", "total_revenue")


def _segments_at(t: Tables, day: str):
    from stocktally.plans.customers import segmentation
    return segmentation(t, day, CFG)


def _segment_history(t: Tables):
    first = history.segment_snapshot(_segments_at(t, "2000-06-15"), None, "2000-06-15")
    return history.segment_snapshot(_segments_at(t, AS_OF), first, AS_OF)


_seg_then = segmentation_sql().replace(AS_OF, "2000-06-15")
M["segments_before"] = _seg_then
M["segment_history"] = f"""with o as (select * from {{segments_before}}), n as (select * from {{d_customer_segmentation}}),
 j as (select o.customer_email as k, o.customer_classification as c0, n.customer_classification as c1, o.rank_id, n.rank_id as rank1,
  (o.customer_classification, o.frequency, o.recency, o.value, o.margin_classification) is distinct from (n.customer_classification, n.frequency, n.recency, n.value, n.margin_classification) as moved
  from o join n using (customer_email))
 select k as customer_email, rank_id, c0 as customer_classification, timestamp '2000-06-15' as valid_from, case when moved then timestamp '{AS_OF}' end as valid_to from j
 union all select k, rank1, c1, timestamp '{AS_OF}', null from j where moved"""
add("scd2_segment_history", lambda t: _segment_history(t).select("customer_email", "rank_id", "customer_classification", "valid_from", "valid_to"),
    "select * from {segment_history}")
add("segments_as_of", lambda t: bi.segments_as_of(_segment_history(t), "2000-12-31"),
    "select customer_classification, count(distinct rank_id) as prior_count from {segments_before} group by 1")

# --- business questions ------------------------------------------------------------------
_DAY = f"created_at = date '{AS_OF}'"
_MONTH = f"date_trunc('month', created_at) = date_trunc('month', date '{AS_OF}')"


def ask(name: str, call, sql: str, digits="") -> None:
    add("vq_" + name, lambda t: call(metrics.Questions(t, AS_OF, CFG)), sql, digits)


_M2 = {"revenue": 2}
ask("revenue_today", lambda q: q.revenue_today(), f"select sum(row_total) as total_revenue from {{active_sales}} where {_DAY}", "total_revenue")
ask("gross_margin_this_month", lambda q: q.gross_margin_this_month(), f"select round((sum(row_total) - sum(cost)) / nullif(sum(row_total), 0) * 100, 2) as gross_margin_pct from {{active_sales}} where {_MONTH}")
ask("top_products_this_week", lambda q: q.top_products_this_week(), f"""select p.product_name, p.sku, sum(row_total) as revenue from {{active_sales}} s join {{d_product}} p using (product_id)
 where created_at >= date_trunc('week', date '{AS_OF}') group by 1, 2 order by 3 desc nulls last, 2 limit 10""", _M2)
ask("orders_last_two_days", lambda q: q.orders_last_two_days(), f"select created_at as order_date, count(distinct order_id) as total_orders from {{active_sales}} where created_at in (date '{AS_OF}' - 1, date '{AS_OF}' - 2) group by 1")
ask("revenue_by_category", lambda q: q.revenue_by_category(), f"select p.primary_category as category, sum(row_total) as revenue from {{active_sales}} join {{d_product}} p using (product_id) where {_MONTH} group by 1", _M2)
ask("top_manufacturers_by_units", lambda q: q.top_manufacturers_by_units(), f"""select p.manufacturer_sku as manufacturer, sum(qty_ordered) as units_sold from {{active_sales}} join {{d_product}} p using (product_id)
 where {_MONTH} group by 1 order by 2 desc nulls last, 1 limit 5""")
ask("units_in_stock_like", lambda q: q.units_in_stock_like("%promo%"), "select sum(qty_available) as units_in_stock from {f_inventoryview} i join {int_product_analyst} p on p.sku = i.part_number where p.caliber ilike '%promo%'")
ask("units_in_stock_by_caliber", lambda q: q.units_in_stock_by_caliber(), """select p.caliber, sum(qty_available) as units_in_stock, sum(extended_cost) as inventory_value from {f_inventoryview} i
 join {int_product_analyst} p on p.sku = i.part_number where p.caliber is not null group by 1 order by 2 desc, 1 limit 20""", {"inventory_value": 2})
ask("slowest_vendors", lambda q: q.slowest_vendors(), """select s_name as vendor_name, round(avg(precise_leadtime), 1) as avg_lead_time_days, count(*) as receipt_count from {f_pos} join supplier on s_suppkey = vendor_id
 where precise_leadtime is not null group by 1 having count(*) >= 5 order by 2 desc, 1 limit 10""")
ask("open_purchase_orders", lambda q: q.open_purchase_orders(), """select purchase_order_id as po_id, s_name as vendor_name, p.sku, p.product_name, quantity_to_fulfill as qty_pending, unit_cost, cast(po_created_at as date) as po_date
 from {f_pos} f join supplier on s_suppkey = vendor_id join {d_product} p on p.sku = f.part_number where datereceived is null and quantity_to_fulfill > 0
 order by po_created_at desc, receipt_item_id limit 50""", "qty_pending unit_cost")
ask("at_risk_regular_count", lambda q: q.segment_size(), "select count(distinct rank_id) as customer_count from {d_customer_segmentation} where customer_classification = 'At-Risk Regular'")
ask("gp_after_variable_cost", lambda q: q.gp_after_variable_cost_today(), f"""select round(sum(row_total) - sum(cost) - sum(freight_cost), 2) as gp_after_variable_cost,
 round((sum(row_total) - sum(cost) - sum(freight_cost)) / nullif(sum(row_total), 0) * 100, 2) as contribution_margin_pct from {{active_sales}} where {_DAY}""")
ask("shipping_share", lambda q: q.shipping_share_today(), f"select round(sum(freight_revenue) / nullif(sum(row_total), 0) * 100, 2) as shipping_revenue_pct from {{active_sales}} where {_DAY}")
ask("sales_by_hour", lambda q: q.sales_by_hour_today(), f"select hour(timedate) as hour_of_day, sum(row_total) as revenue, count(distinct order_id) as orders from {{active_sales}} where {_DAY} group by 1", _M2)
ask("revenue_mtd_vs_prior", lambda q: q.revenue_mtd_vs_prior(), f"""select 'Current MTD' as period, sum(row_total) as revenue from {{active_sales}} where created_at between date '2001-06-01' and date '{AS_OF}'
 union all select 'Prior Month MTD', sum(row_total) from {{active_sales}} where created_at between date '2001-05-01' and date '2001-05-15'""", _M2)
ask("revenue_ytd_vs_prior", lambda q: q.revenue_ytd_vs_prior(), f"""select 'Current YTD' as period, sum(row_total) as revenue from {{active_sales}} where created_at between date '2001-01-01' and date '{AS_OF}'
 union all select 'Prior Year YTD', sum(row_total) from {{active_sales}} where created_at between date '2000-01-01' and date '2000-06-15'""", _M2)
ask("daily_revenue_30_days", lambda q: q.daily_revenue_30_days(), f"select created_at as sale_date, sum(row_total) as revenue, count(distinct order_id) as orders from {{active_sales}} where created_at >= date '{AS_OF}' - 30 group by 1", _M2)
ask("revenue_by_caliber", lambda q: q.revenue_by_caliber(), f"select p.caliber, sum(row_total) as revenue, sum(qty_ordered) as units_sold from {{active_sales}} join {{d_product}} p using (product_id) where {_MONTH} group by 1", _M2)
ask("margin_by_manufacturer", lambda q: q.margin_by_manufacturer(), f"""select p.manufacturer_sku as manufacturer, sum(row_total) as revenue, sum(cost) as total_cost,
 round((sum(row_total) - sum(cost)) / nullif(sum(row_total), 0) * 100, 2) as margin_pct from {{active_sales}} join {{d_product}} p using (product_id)
 where {_MONTH} group by 1 having sum(row_total) > 0 order by 2 desc, 1 limit 20""", {"revenue": 2, "total_cost": 2})
ask("revenue_by_storefront", lambda q: q.revenue_by_storefront(), f"""select storefront, sum(row_total) as revenue, count(distinct order_id) as orders, round(sum(row_total) / nullif(count(distinct order_id), 0), 2) as aov
 from {{active_sales}} where {_MONTH} group by 1""", _M2)
ask("top_states", lambda q: q.top_states(), f"""select region as state, sum(row_total) as revenue, count(distinct order_id) as orders from {{active_sales}} where {_MONTH} and region is not null
 group by 1 order by 2 desc, 1 limit 15""", _M2)
ask("aov_by_store", lambda q: q.aov_by_store(), f"""select s.store_id, n_name as store_name, round(sum(row_total) / nullif(count(distinct order_id), 0), 2) as aov, count(distinct order_id) as orders
 from {{active_sales}} s left join nation on n_nationkey = s.store_id where {_MONTH} group by 1, 2""")
ask("inventory_value", lambda q: q.inventory_value(), "select sum(qty_available) as total_units, sum(extended_cost) as total_value from {f_inventoryview}", {"total_value": 2})
ask("segment_distribution", lambda q: q.segment_distribution(), """select customer_classification as segment, count(distinct rank_id) as customer_count, round(avg(total_revenue), 2) as avg_revenue,
 round(avg(days_since_last_purchase), 0) as avg_days_since_last from {d_customer_segmentation} group by 1""")
_MET = ("total_revenue", "total_orders", "gross_profit", "gross_margin", "aov", "total_units", "gp_after_variable_cost", "shipping_pct")
add("metric_sales_by_storefront", lambda t: metrics.metric(t, "sales", _MET, ["storefront"], ["standard_statuses"]),
    """select storefront, sum(row_total) as total_revenue, count(distinct order_id) as total_orders, sum(row_total) - sum(cost) as gross_profit,
 (sum(row_total) - sum(cost)) / nullif(sum(row_total), 0) as gross_margin, sum(row_total) / nullif(count(distinct order_id), 0) as aov, sum(qty_ordered) as total_units,
 sum(row_total) - sum(cost) - sum(freight_cost) as gp_after_variable_cost, round(sum(freight_revenue) / nullif(sum(row_total), 0) * 100, 2) as shipping_pct from {active_sales} group by 1""",
    {c: 2 for c in ("total_revenue", "gross_profit", "aov", "gp_after_variable_cost")} | {"gross_margin": 6})
add("metric_sales_by_product_type", lambda t: metrics.metric(t, "sales", ["total_revenue", "total_orders"], ["use_type_category"], ["standard_statuses"], "products"),
    "select p.use_type_category, sum(row_total) as total_revenue, count(distinct order_id) as total_orders from {active_sales} left join {int_product_analyst} p using (product_id) group by 1", {"total_revenue": 2})
add("metric_inventory", lambda t: metrics.metric(t, "inventory", ["total_on_hand", "total_inventory_value", "total_on_order"]),
    "select sum(qty_available) as total_on_hand, sum(extended_cost) as total_inventory_value, sum(qty_on_order) as total_on_order from {f_inventoryview}", {"total_inventory_value": 2, "total_on_order": 2})
add("metric_purchases_by_vendor", lambda t: metrics.metric(t, "purchase_orders", ["avg_lead_time", "total_po_cost", "total_qty_received"], ["vendor_name"], (), "vendors"),
    "select s_name as vendor_name, avg(precise_leadtime) as avg_lead_time, sum(total_cost) as total_po_cost, sum(qty) as total_qty_received from {f_pos} left join supplier on s_suppkey = vendor_id group by 1",
    {"avg_lead_time": 4, "total_po_cost": 2, "total_qty_received": 2})
add("metric_segments", lambda t: metrics.metric(t, "customer_segments", ["customer_count", "avg_customer_revenue"], ["customer_classification"]),
    "select customer_classification, count(distinct rank_id) as customer_count, avg(total_revenue) as avg_customer_revenue from {d_customer_segmentation} group by 1", "avg_customer_revenue")
