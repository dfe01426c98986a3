"""Forecasts by Holt-Winters smoothing, its rates chosen per series by rolling origins, with bounds from its own errors.

Level, trend and weekday effect of a series are one state that every day moves on: a fold over the series' days in
order. A fold's input is bounded by the calendar, never by the rows behind a day; rates and series are spread over
tasks.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

WEEK = 7
# Rates of level, trend and weekday effect that are tried, in this order.
GRID = tuple(itertools.product((0.01, 0.05, 0.2), (0.0, 0.02), (0.01, 0.1)))
_STATE = "struct<level:double,trend:double,season:array<double>>"


def daily_arrays(history: DataFrame, series: Sequence[str], ts: str, y: str) -> DataFrame:
    """(series, first_day, n, ys): a value for each day from a series' first to its last; days without rows are 0."""
    day = F.col(ts).cast("date")
    sums = history.filter(F.col(ts).isNotNull()).groupBy(*series, day.alias("__day")).agg(F.coalesce(F.sum(F.col(y).cast("double")), F.lit(0.0)).alias("__y"))
    spans = sums.groupBy(*series).agg(F.min("__day").alias("first_day"), F.max("__day").alias("__last"))
    days = spans.select(*series, "first_day", F.explode(F.sequence("first_day", "__last")).alias("__day"))
    same = [days[c].eqNullSafe(sums[c]) for c in series]
    on = days["__day"] == sums["__day"]
    for s in same:
        on = on & s
    full = days.join(sums, on, "left").select(*[days[c] for c in series], "first_day", days["__day"], F.coalesce("__y", F.lit(0.0)).alias("__y"))
    rows = full.groupBy(*series, "first_day").agg(F.array_sort(F.collect_list(F.struct("__day", "__y"))).alias("__rows"))
    return rows.select(*series, "first_day", F.size("__rows").alias("n"), F.transform("__rows", lambda r: r["__y"]).alias("ys"))


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.size(values)


def _fold(a: Column, b: Column, g: Column, cuts: Column) -> Column:
    """States after the days whose numbers are in cuts, and after the last: the fold of `ys` from its second week on."""
    first = F.slice("ys", 1, WEEK)
    level = _mean(first)
    trend = (_mean(F.slice("ys", WEEK + 1, WEEK)) - level) / WEEK
    start = F.struct(
        level.alias("level"), trend.alias("trend"), F.transform(first, lambda v: v - level).alias("season"),
        F.lit(WEEK).alias("i"), F.array().cast(f"array<{_STATE}>").alias("saved"),
    )

    def step(s: Column, v: Column) -> Column:
        season = s["season"][0]
        level = a * (v - season) + (1 - a) * (s["level"] + s["trend"])
        trend = b * (level - s["level"]) + (1 - b) * s["trend"]
        turned = F.concat(F.slice(s["season"], 2, WEEK - 1), F.array(g * (v - level) + (1 - g) * season))
        state = F.struct(level.alias("level"), trend.alias("trend"), turned.alias("season"))
        i = s["i"] + 1
        saved = F.when(F.array_contains(cuts, i), F.concat(s["saved"], F.array(state))).otherwise(s["saved"])
        return F.struct(level.alias("level"), trend.alias("trend"), turned.alias("season"), i.alias("i"), saved.alias("saved"))

    return F.aggregate(F.slice("ys", WEEK + 1, F.greatest(F.col("n") - WEEK, F.lit(0))), start, step)


def ahead(state: Column, h: Column) -> Column:
    """Value h days after a state, not below zero."""
    return F.greatest(state["level"] + h * state["trend"] + F.get(state["season"], ((h - 1) % WEEK).cast("int")), F.lit(0.0))


def _folded(arrays: DataFrame, origins: int, stride: int, horizon: int) -> DataFrame:
    """One row per series and rates: the states at its origins, oldest first, and the last state.

    Origins lie `stride` days apart, the newest `horizon` days before the end; those in the first two weeks are left out.
    """
    newest = F.col("n") - horizon
    cuts = F.filter(F.transform(F.sequence(F.lit(origins - 1), F.lit(0), F.lit(-1)), lambda k: (newest - k * stride).cast("int")), lambda c: c >= 2 * WEEK)
    grid = F.array(*[F.struct(F.lit(p).alias("p"), *[F.lit(v).alias(c) for v, c in zip(rates, "abg", strict=True)]) for p, rates in enumerate(GRID)])
    rows = arrays.filter(F.col("n") >= 2 * WEEK).withColumn("cuts", cuts).select("*", F.inline(grid))
    return rows.repartition(*[c for c in arrays.columns if c not in ("ys", "n", "first_day")], "p").withColumn("end", _fold(F.col("a"), F.col("b"), F.col("g"), F.col("cuts")))


def _errors(folded: DataFrame, series: Sequence[str], horizon: int) -> DataFrame:
    """(series, p, origin, step, actual, predicted) of all origins."""
    saved = folded.select(*series, "p", "ys", "cuts", F.posexplode("end.saved").alias("k", "state"))
    steps = saved.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("origin", F.get("cuts", F.col("k")))
    return steps.select(*series, "p", "origin", "step", F.get("ys", F.col("origin") + F.col("step") - 1).alias("actual"), ahead(F.col("state"), F.col("step")).alias("predicted"))


def chosen_rates(folded: DataFrame, series: Sequence[str], horizon: int) -> DataFrame:
    """(series, p): the rates with the least sum of absolute errors over all origins; of equal ones the first of the grid.

    A series too short for an origin gets the first.
    """
    loss = _errors(folded, series, horizon).groupBy(*series, "p").agg(F.sum(F.abs(F.col("actual") - F.col("predicted"))).alias("loss"))
    every = folded.select(*series, "p").join(loss.withColumnsRenamed({c: f"__{c}" for c in [*series, "p"]}), _same(series), "left")
    best = every.groupBy(*series).agg(F.min(F.struct(F.round(F.coalesce("loss", F.lit(0.0)), 6).alias("loss"), "p")).alias("best"))
    return best.select(*series, F.col("best.p").alias("p"))


def _same(series: Sequence[str], extra: Sequence[str] = ("p",)) -> Column:
    on = F.lit(True)
    for c in [*series, *extra]:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return on


def _best(history: DataFrame, series: Sequence[str], ts: str, y: str, horizon: int, origins: int, stride: int) -> DataFrame:
    """Folded rows of the chosen rates."""
    folded = _folded(daily_arrays(history, series, ts, y), origins, stride, horizon)
    best = chosen_rates(folded, series, horizon).withColumnsRenamed({c: f"__{c}" for c in [*series, "p"]})
    return folded.join(best, _same(series), "left_semi")


def smooth_forecast(history: DataFrame, series: Sequence[str], ts: str, y: str, horizon: int = 30, origins: int = 6, stride: int = 30) -> DataFrame:
    """Next `horizon` days of every series: series, forecast_date, predicted_units, and the rates a, b, g behind them.

    Series of less than two weeks have no forecast. Null keys are a series, days without rows count as zero.
    """
    best = _best(history, series, ts, y, horizon, origins, stride)
    steps = best.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    date = F.date_add("first_day", (F.col("n") + F.col("step") - 1).cast("int"))
    return steps.select(*series, date.alias("forecast_date"), ahead(F.col("end"), F.col("step")).alias("predicted_units"), "a", "b", "g")


def residual_sketches(history: DataFrame, series: Sequence[str], ts: str, y: str, horizon: int = 30, origins: int = 26, stride: int = 14) -> DataFrame:
    """(series, week, errors, sketch): quantile sketches of actual less predicted, by week of the horizon, over all origins."""
    found = _errors(_best(history, series, ts, y, horizon, origins, stride), series, horizon)
    week = ((F.col("step") - 1) / WEEK).cast("int").alias("week")
    return found.groupBy(*series, week).agg(F.count(F.lit(1)).alias("errors"), F.kll_sketch_agg_double(F.col("actual") - F.col("predicted")).alias("sketch"))


def with_bounds(predicted: DataFrame, sketches: DataFrame, series: Sequence[str], step: Column, level: float = 0.95) -> DataFrame:
    """Predictions with lower_bound and upper_bound: the quantiles of past errors at the same distance, no law assumed."""
    rows = predicted.withColumn("week", ((step - 1) / WEEK).cast("int"))
    held = sketches.select(*[F.col(c).alias(f"__{c}") for c in [*series, "week"]], "sketch")
    joined = rows.join(held, _same(series, ("week",)), "left")
    edge = lambda q: F.greatest(F.col("predicted_units") + F.kll_sketch_get_quantile_double("sketch", F.lit(q)), F.lit(0.0))
    return joined.withColumns({"lower_bound": edge((1 - level) / 2), "upper_bound": edge((1 + level) / 2)}).drop("sketch", "week", *[f"__{c}" for c in [*series, "week"]])


def error_percentile(rows: DataFrame, error: Column, sketch: str = "sketch") -> DataFrame:
    """rows with the share of past errors up to theirs: a percentile by rank, for anomaly flags."""
    return rows.withColumn("percentile", F.kll_sketch_get_rank_double(F.col(sketch), error))


def smooth_backtest(history: DataFrame, series: Sequence[str], ts: str, y: str, cutoff: str, horizon: int = 30, origins: int = 6, stride: int = 30) -> DataFrame:
    """Mean absolute percentage error per series on the days after a cutoff that have a value above zero.

    Rates are chosen on the days up to the cutoff only. The days are those that `forecast.backtest` counts.
    """
    day, end = F.col(ts).cast("date"), F.lit(cutoff).cast("date")
    made = smooth_forecast(history.filter(day <= end), series, ts, y, 2 * horizon, origins, stride)
    made = made.withColumnsRenamed({c: f"__{c}" for c in series})
    actual = history.filter((day > end) & (day <= F.date_add(end, horizon)) & (F.col(y) > 0)).withColumn("forecast_date", day)
    error = F.abs(F.col(y).cast("double") - F.col("predicted_units")) / F.col(y).cast("double") * 100
    joined = actual.join(made, _same(series, ()) & (actual["forecast_date"] == made["forecast_date"]))
    return joined.groupBy(*series).agg(F.avg(error).alias("mape"), F.count(F.lit(1)).alias("days"))
