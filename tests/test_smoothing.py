"""Holt-Winters folds, rolling origins and error quantiles against plain Python."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktally.plans import smoothing as S

START = dt.date(2024, 1, 1)


def folded(ys, a, b, g, until):
    level = sum(ys[:7]) / 7
    trend = (sum(ys[7:14]) / 7 - level) / 7
    season = [v - level for v in ys[:7]]
    for v in ys[7:until]:
        new = a * (v - season[0]) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        season = [*season[1:], g * (v - new) + (1 - g) * season[0]]
        level = new
    return lambda h: max(level + h * trend + season[(h - 1) % 7], 0)


def by_force(ys, horizon, origins, stride):
    cuts = [c for c in (len(ys) - horizon - k * stride for k in range(origins)) if c >= 14]
    loss = []
    for p, rates in enumerate(S.GRID):
        total = 0.0
        for c in cuts:
            at = folded(ys, *rates, c)
            total += sum(abs(ys[c + h - 1] - at(h)) for h in range(1, horizon + 1))
        loss.append((round(total, 6), p))
    return S.GRID[min(loss)[1]]


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(1)
    shapes = {
        "weekly": [50 + 30 * (i % 7 == 5) + 0.5 * i + float(rng.normal()) for i in range(120)], "noise": [abs(float(x)) for x in rng.normal(10, 5, 90)],
        "short": [1.0, 2.0, 3.0], "two weeks": [float(i) for i in range(14)], None: [5.0] * 40, "falling": [max(100.0 - 4 * i, 0.0) for i in range(60)],
    }
    rows = [(k, START + dt.timedelta(days=i), v) for k, ys in shapes.items() for i, v in enumerate(ys)]
    rows += [("weekly", START, 0.0), ("weekly", None, 7.0), ("noise", START + dt.timedelta(days=3), None)]
    return shapes, spark.createDataFrame(rows, "name string, day date, y double")


def test_forecasts_and_rates_against_force(spark, series):
    shapes, df = series
    got = {}
    for r in S.smooth_forecast(df, ["name"], "day", "y", 10, 3, 9).collect():
        got.setdefault(r.name if hasattr(r, "name") and not callable(r.name) else r["name"], {})[r["forecast_date"]] = r
    assert set(got) == set(shapes) - {"short"}
    for name, days in got.items():
        ys = shapes[name]
        rates = by_force(ys, 10, 3, 9)
        at = folded(ys, *rates, len(ys))
        assert sorted(days) == [START + dt.timedelta(days=len(ys) + h) for h in range(10)]
        for day, r in days.items():
            assert (r["a"], r["b"], r["g"]) == rates and abs(r["predicted_units"] - at((day - START).days - len(ys) + 1)) < 1e-9
    assert S.smooth_forecast(df.limit(0), ["name"], "day", "y").count() == 0


def test_days_without_rows_are_zero(spark):
    rows = [("a", START, 1.0), ("a", START + dt.timedelta(days=20), 3.0)]
    r = S.daily_arrays(spark.createDataFrame(rows, "name string, day date, y double"), ["name"], "day", "y").collect()[0]
    assert r["n"] == 21 and r["ys"] == [1.0, *[0.0] * 19, 3.0]


def test_a_backtest_sees_only_the_past(spark, series):
    _, df = series
    later = df.withColumn("y", F.when(F.col("day") > "2024-03-20", 1e6).otherwise(F.col("y")))
    made = [S.smooth_forecast(x.filter("day <= '2024-03-20'"), ["name"], "day", "y").filter("name = 'weekly'").select("predicted_units").collect() for x in (df, later)]
    assert made[0] == made[1]
    mape = {r["name"]: r["mape"] for r in S.smooth_backtest(df, ["name"], "day", "y", "2024-04-01", 14).collect()}
    assert mape["weekly"] < 10


def test_bounds_hold_the_errors_they_come_from(spark):
    rng = np.random.default_rng(3)
    ys = rng.exponential(10, 700) + 5  # errors far from a normal law
    df = spark.createDataFrame([("s", START + dt.timedelta(days=i), float(v)) for i, v in enumerate(ys)], "name string, day date, y double")
    past = df.filter(F.col("day") < START + dt.timedelta(days=600))
    sketches = S.residual_sketches(past, ["name"], "day", "y", 28, 30, 7)
    assert {r["week"]: r["errors"] for r in sketches.collect()} == {w: 210 for w in range(4)}
    made = S.smooth_forecast(past, ["name"], "day", "y", 28)
    bounded = S.with_bounds(made, sketches, ["name"], F.datediff("forecast_date", F.lit(START)) - 599, 0.9).collect()
    inside = np.mean([r["lower_bound"] <= ys[600 + i] <= r["upper_bound"] for i, r in enumerate(sorted(bounded, key=lambda r: r["forecast_date"]))])
    assert len(bounded) == 28 and inside >= 0.75 and all(r["upper_bound"] - r["predicted_units"] > r["predicted_units"] - r["lower_bound"] for r in bounded)
    ranks = S.error_percentile(sketches.filter("week = 0"), F.lit(1e9)).first()["percentile"], S.error_percentile(sketches.filter("week = 0"), F.lit(-1e9)).first()["percentile"]
    assert ranks == (1.0, 0.0)
