"""Interval joins, parity by digests, sketches, variants and bucketed tables on small inputs; the shape of their plans."""

import datetime as dt
import itertools
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktally.functions import variants
from stocktally.operators import joins, parity, sketches
from stocktally.session import shared_folder
from workload import queries_mechanisms
from workload.tables import tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("closed", ["left", "both"])
def test_interval_join_against_force(spark, closed):
    rng = np.random.default_rng(1)
    points = [(k, float(x)) for k, x in enumerate(rng.choice([0, 1, -1, 2.5, 1e6, -1e6, 0.125, 7, 7, 1023.999, 1024], 40))] + [(100, None), (101, 3.0)]
    ranges = [(k, float(a), float(a + w)) for k, (a, w) in enumerate(zip(rng.choice([-2, -1, 0, 0.125, 1, 2.5, 7, 500], 60), rng.choice([0, 1e-9, 0.5, 1, 7, 1000, 3e6, -1], 60), strict=True))]
    ranges += [(200, None, 1.0), (201, 1.0, None)]
    inside = lambda p, a, b: a <= p and (p < b if closed == "left" else p <= b)
    want = [(i, j) for (i, p), (j, a, b) in itertools.product(points, ranges) if p is not None and a is not None and b is not None and inside(p, a, b)]
    left, right = spark.createDataFrame(points, "i int, p double"), spark.createDataFrame(ranges, "j int, a double, b double")
    got = sorted((r.i, r.j) for r in joins.interval_join(left, "p", right, "a", "b", closed=closed).collect())
    assert got == sorted(want) and len(want) > 100
    outer = [(r.i, r.j) for r in joins.interval_join(left, "p", right, "a", "b", "left", closed).collect()]
    alone = [(i, None) for i, _ in points if i not in {w[0] for w in want}]
    assert sorted(outer, key=str) == sorted([*want, *alone], key=str) and (100, None) in outer
    assert joins.interval_join(left.limit(0), "p", right, "a", "b").count() == 0
    assert joins.interval_join(left, "p", right.limit(0), "a", "b").count() == 0
    assert joins.interval_join(left, "p", right.limit(0), "a", "b", "left").count() == len(points)
    with pytest.raises(ValueError):
        joins.interval_join(left, "p", right, "a", "b", "full")


def test_interval_join_of_dates_and_its_plan(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    left = spark.createDataFrame([(n, day(n)) for n in range(40)], "n int, d date")
    right = spark.createDataFrame([("long", day(-4000), day(4000)), ("day", day(5), day(6)), ("none", day(6), day(5))], "name string, a date, b date")
    got = joins.interval_join(left, "d", right, "a", "b")
    assert got.filter("name = 'long'").count() == 40 and [r.n for r in got.filter("name = 'day'").collect()] == [5]
    plan = plan_of(queries_mechanisms.events_in_windows(tables(spark, FOLDER)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "__bin" in plan


def test_parity_against_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(rng.integers(0, 60)) if k else None, str(rng.integers(0, 3)), None if rng.random() < 0.3 else float(rng.integers(0, 3))) for k in range(200)]
    other = [r for r in rows if r[0] != 7] + [(99, "x", 1.0), (8, "more", None), rows[3], (None, "n", None)]
    other[0] = (other[0][0], other[0][2] and str(other[0][2]), None)
    schema = "id int, a string, b double"
    left, right = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema).select("b", "id", "a").repartition(3)
    want = []
    for key in {r[0] for r in rows + other}:
        x, y = (sorted((str(r) for r in side if r[0] == key)) for side in (rows, other))
        if x != y:
            want.append((key, len(x), len(y), "right_only" if not x else "left_only" if not y else "changed"))
    for fan_out, depth in ((2, 1), (4, 3), (256, 2)):
        got = parity.digest_parity(left, right, ["id"], fan_out=fan_out, depth=depth)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert parity.digest_parity(left, left.repartition(4), ["id"]).count() == 0
    assert parity.digest_parity(left.limit(0), left.limit(0), ["id"]).count() == 0
    assert parity.digest_parity(left.limit(0), left, ["id"]).filter("state <> 'right_only'").count() == 0
    # A null that changes places with a value, and rows that come twice, are seen.
    one = spark.createDataFrame([(1, "a", None, 1), (2, "x", "x", 1), (2, "x", "x", 1)], "id int, p string, q string, n int")
    two = spark.createDataFrame([(1, None, "a", 1), (2, "x", "x", 1)], "id int, p string, q string, n int")
    assert {r.id: (r.left_rows, r.right_rows, r.state) for r in parity.digest_parity(one, two, ["id"]).collect()} == {1: (1, 1, "changed"), 2: (2, 1, "changed")}
    assert parity.digest_parity(one, two.filter("id = 2"), ["id"], ["n"]).count() == 2


def test_sketches_merge_over_days_and_replace_a_day(spark):
    path = f"{shared_folder(spark)}/sketch-{uuid.uuid4().hex}"
    base = spark.range(60_000).select(F.date_add(F.lit("2024-01-30").cast("date"), (F.col("id") % 5).cast("int")).alias("d"), (F.col("id") % 20_000).cast("string").alias("v"), F.lit("s").alias("g"))
    for rows in (base.filter("d < '2024-02-01'"), base.filter("d >= '2024-01-31'")):
        sketches.store_sketches(spark, path, sketches.daily_sketches(rows, F.col("d"), "v", ["g"]), ["g"])
    stored = sketches.stored_sketches(spark, path)
    assert stored.count() == 5
    whole = sketches.distinct_over(stored).first()
    assert whole.records == 60_000 and abs(whole.distinct_values - 20_000) <= sketches.ERROR * 20_000
    few = sketches.daily_sketches(spark.createDataFrame([("2024-01-01", "a"), ("2024-01-01", "a"), ("2024-01-02", None)], "d string, v string"), F.col("d").cast("date"), "v")
    assert sorted((str(r.day), r.distinct_values, r.records) for r in sketches.distinct_over(few, ["day"]).collect()) == [("2024-01-01", 1, 2), ("2024-01-02", 0, 1)]
    with pytest.raises(FileNotFoundError):
        sketches.stored_sketches(spark, path + "-none")


def test_variants_of_odd_documents(spark):
    texts = [('{"25": {"value": " x "}, "n": 1.5}',), ("no json",), (None,), ("[1, 2]",), ('{"n": "text"}',), ("",)]
    got = variants.shred(spark.createDataFrame(texts, "doc string"), "doc", {"link": ("$.25.value", "string"), "n": ("$.n", "double"), "first": ("$[0]", "int")})
    assert got.columns == ["variant", "link", "n", "first"]
    assert [(r.link, r.n, r.first) for r in got.select("link", "n", "first").collect()] == [(" x ", 1.5, None), (None,) * 3, (None,) * 3, (None, None, 1), (None,) * 3, (None,) * 3]


def test_bucketed_tables_join_without_an_exchange(spark):
    plan = plan_of(queries_mechanisms.bucketed_sales(tables(spark, FOLDER)))
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
