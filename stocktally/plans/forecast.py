"""Daily-series forecasts, anomaly flags and accuracy, as plain aggregations.

A series is modelled as a straight trend plus a weekday effect. All parameters come
from sums per (series, weekday), so the history is read once, summed map-side, and
everything after works on seven rows per series.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from stocktally.functions.scalars import normal_cdf, safe_div
from stocktally.operators.windows import first_per_key

ORIGIN = "2000-01-01"  # day numbers stay small, which keeps the sums well conditioned


def _day_number(day: Column | str) -> Column:
    return F.datediff(day, F.lit(ORIGIN).cast("date"))


def fit(history: DataFrame, series: Sequence[str], ts: str, y: str) -> DataFrame:
    """Trend, weekday effects and residual spread per series; one row per series.

    `weekday_effect` maps weekday (Monday = 0) to its mean residual.
    """
    day, value = _day_number(ts).cast("double"), F.col(y).cast("double")
    rows = history.filter(F.col(y).isNotNull()).select(
        *series, F.weekday(ts).alias("dow"), F.col(ts).cast("date").alias("day"), day.alias("t"), value.alias("y")
    )
    moments = rows.groupBy(*series, "dow").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("t").alias("st"), F.sum("y").alias("sy"),
        F.sum(F.col("t") * F.col("t")).alias("stt"), F.sum(F.col("y") * F.col("y")).alias("syy"),
        F.sum(F.col("t") * F.col("y")).alias("sty"), F.max("day").alias("last_day"),
    )
    weekday_rows = F.collect_list(F.struct("dow", "n", "st", "sy"))
    totals = moments.groupBy(*series).agg(
        *[F.sum(c).alias(c) for c in ("n", "st", "sy", "stt", "syy", "sty")],
        F.max("last_day").alias("last_day"), weekday_rows.alias("days"),
    )
    n, st, sy = F.col("n"), F.col("st"), F.col("sy")
    sxx = F.col("stt") - st * st / n
    trend = totals.withColumn("slope", F.coalesce(safe_div(F.col("sty") - st * sy / n, sxx), F.lit(0.0)))
    trend = trend.withColumn("intercept", (F.col("sy") - F.col("slope") * F.col("st")) / F.col("n"))
    effects = F.transform(
        "days",
        lambda d: F.struct(
            d["dow"].alias("dow"), d["n"].alias("n"),
            ((d["sy"] - F.col("intercept") * d["n"] - F.col("slope") * d["st"]) / d["n"]).alias("w"),
        ),
    )
    trend = trend.withColumn("effects", effects)
    a, b = F.col("intercept"), F.col("slope")
    squared = (
        F.col("syy") - 2 * a * F.col("sy") - 2 * b * F.col("sty") + F.col("n") * a * a
        + 2 * a * b * F.col("st") + b * b * F.col("stt")
    )
    explained = F.aggregate("effects", F.lit(0.0), lambda acc, e: acc + e["n"] * e["w"] * e["w"])
    left = F.greatest(squared - explained, F.lit(0.0))
    return trend.select(
        *series, "n", "last_day", "slope", "intercept",
        F.map_from_entries(F.transform("effects", lambda e: F.struct(e["dow"], e["w"]))).alias("weekday_effect"),
        F.sqrt(safe_div(left, F.greatest(F.col("n") - 1, F.lit(1.0)))).alias("sigma"),
    )


def expected(day: Column | str) -> Column:
    """Model value on a day, from the columns of `fit`."""
    effect = F.coalesce(F.try_element_at("weekday_effect", F.weekday(day)), F.lit(0.0))
    return F.col("intercept") + F.col("slope") * _day_number(day) + effect


def forecast(
    history: DataFrame, series: Sequence[str], ts: str, y: str, horizon: int = 30, level: float = 0.95,
) -> DataFrame:
    """Next `horizon` days of every series with bounds at the given level."""
    z = NormalDist().inv_cdf(0.5 + level / 2)
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    ahead = fit(history, series, ts, y).withColumn("step", steps).withColumn("forecast_date", F.date_add("last_day", F.col("step")))
    predicted = ahead.withColumn("predicted_units", expected("forecast_date"))
    return predicted.select(
        *series, "forecast_date", "predicted_units",
        (F.col("predicted_units") - z * F.col("sigma")).alias("lower_bound"),
        (F.col("predicted_units") + z * F.col("sigma")).alias("upper_bound"),
    )


def forecast_table(predictions: DataFrame, series: Column | str, forecast_type: str, trained_at: str) -> DataFrame:
    """Predictions in the layout of the forecast table."""
    money = "decimal(18,4)"
    return predictions.select(
        (F.col(series) if isinstance(series, str) else series).alias("caliber"), "forecast_date",
        *[F.col(c).cast(money).alias(c) for c in ("predicted_units", "lower_bound", "upper_bound")],
        F.lit(forecast_type).alias("forecast_type"), F.lit(trained_at).cast("timestamp").alias("trained_at"),
    )


def revenue_forecast(daily_revenue: DataFrame, trained_at: str, horizon: int = 30, level: float = 0.95) -> DataFrame:
    """Forecast of one total series."""
    one = daily_revenue.withColumn("series", F.lit("REVENUE"))
    return forecast_table(forecast(one, ["series"], "sale_date", "total_revenue", horizon, level), "series", "revenue", trained_at)


def detect_anomalies(
    train: DataFrame, detect: DataFrame, series: Sequence[str], ts: str, y: str, level: float = 0.99,
) -> DataFrame:
    """Score new days against a model of older days.

    distance is in residual spreads, percentile its normal probability.
    """
    z = NormalDist().inv_cdf(0.5 + level / 2)
    scored = detect.join(fit(train, series, ts, y), list(series)).withColumn("expected_value", expected(ts))
    scored = scored.withColumn("distance", safe_div(F.col(y).cast("double") - F.col("expected_value"), F.col("sigma")))
    return scored.select(
        *series, F.col(ts).alias("anomaly_date"), F.col(y).cast("double").alias("actual_value"), "expected_value",
        F.coalesce(F.abs("distance") > z, F.lit(False)).alias("is_anomaly"), normal_cdf("distance").alias("percentile"), "distance",
    )


def metric_anomalies(daily: DataFrame, as_of: str, days: int = 30, level: float = 0.99) -> DataFrame:
    """Revenue, order and margin anomalies of the last days, trained on all before."""
    metrics = {"revenue": "daily_revenue", "orders": "daily_orders", "margin": "daily_margin_pct"}
    pairs = F.explode(F.create_map(*[x for k, c in metrics.items() for x in (F.lit(k), F.col(c).cast("double"))]))
    long = daily.select("sale_date", pairs.alias("metric_name", "y"))
    cut = F.date_sub(F.lit(as_of).cast("date"), days)
    return detect_anomalies(
        long.filter(F.col("sale_date") < cut), long.filter(F.col("sale_date") >= cut), ["metric_name"], "sale_date", "y", level
    )


def backtest(history: DataFrame, series: Sequence[str], ts: str, y: str, cutoff: str, horizon: int = 30, min_days: int = 0) -> DataFrame:
    """Mean absolute percentage error per series on the days after a cutoff.

    The model is evaluated on the days that have actual values.
    """
    day = F.col(ts).cast("date")
    end = F.lit(cutoff).cast("date")
    model = fit(history.filter(day <= end), series, ts, y)
    if min_days:
        model = model.filter(F.col("n") >= min_days)
    actual = history.filter((day > end) & (day <= F.date_add(end, horizon)) & (F.col(y) > 0))
    error = F.abs(F.col(y).cast("double") - expected(ts)) / F.col(y).cast("double") * 100
    return actual.join(model, list(series)).groupBy(*series).agg(
        F.avg(error).alias("mape"), F.count(F.lit(1)).alias("days")
    )


def forecast_accuracy(actuals: DataFrame, history: DataFrame, series: str, day: str, units: str, min_days: int = 7) -> DataFrame:
    """Error, bias and band coverage of the earliest archived prediction per day."""
    first = first_per_key(
        history.select(series, "forecast_date", "predicted_units", "lower_bound", "upper_bound", "archived_at"),
        [series, "forecast_date"], [F.col("archived_at").asc_nulls_last(), F.col("predicted_units").asc_nulls_last()],
    ).withColumnRenamed("forecast_date", day)
    miss = F.col(units) - F.col("predicted_units")
    inside = F.col(units).between(F.col("lower_bound"), F.col("upper_bound"))
    return (
        actuals.join(first, [series, day]).groupBy(series).agg(
            F.count(F.lit(1)).alias("matched_days"), F.round(F.avg(F.abs(miss)), 1).alias("mae"),
            F.round(F.avg(safe_div(F.abs(miss), units)) * 100, 1).alias("mape"), F.round(F.avg(miss), 1).alias("bias"),
            F.count_if(inside).alias("within_band"),
        ).filter(F.col("matched_days") >= min_days)
        .withColumn("coverage_pct", F.round(F.col("within_band") / F.col("matched_days") * 100, 1))
    )


def project_inventory(
    on_hand: DataFrame, arrivals: DataFrame, daily_rate: DataFrame, keys: Sequence[str], start: str, end: str,
) -> DataFrame:
    """Stock per day: on hand plus arrivals so far less the daily rate, never below zero.

    on_hand(keys, qty), arrivals(keys, day, qty), daily_rate(keys, rate). One row per
    key and day of the span; stockout_date is the first day at zero.
    """
    if not keys:
        whole = project_inventory(*[f.withColumn("__all", F.lit(1)) for f in (on_hand, arrivals, daily_rate)], ["__all"], start, end)
        return whole.drop("__all")
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    grid = on_hand.withColumnRenamed("qty", "on_hand").withColumn("day", F.explode(days))
    landed = arrivals.groupBy(*keys, "day").agg(F.sum("qty").alias("arrived"))
    rows = grid.join(landed, [*keys, "day"], "left").join(daily_rate, list(keys), "left")
    rows = rows.withColumns({
        "arrived": F.coalesce(F.col("arrived").cast("double"), F.lit(0.0)), "rate": F.coalesce(F.col("rate").cast("double"), F.lit(0.0)),
    })
    # A window holds the days of the span for one key.
    along = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    running = F.col("on_hand").cast("double") + F.sum(F.col("arrived") - F.col("rate")).over(along)
    projected = rows.withColumn("projected_qty", F.greatest(running, F.lit(0.0)))
    whole = Window.partitionBy(*keys)
    return projected.withColumn(
        "stockout_date", F.min(F.when(F.col("projected_qty") <= 0, F.col("day"))).over(whole)
    ).select(*keys, "day", "arrived", "projected_qty", "stockout_date")
