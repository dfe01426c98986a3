"""How rows move: rows that need not meet a partner, marks beside joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktally.operators import joins


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_parent_stay_where_they_are(spark):
    rows = [(1, None, "configurable", 5.0), (2, 1, "simple", None), (3, None, "simple", 7.0), (4, 9, "simple", 8.0), (None, None, "simple", 1.0),
            (2, 1, "simple", 2.0), (1, None, "configurable", 6.0)]
    df = spark.createDataFrame(rows, "id int, parent int, kind string, v double")
    out = joins.inherit_from_parent(df, "id", "parent", F.col("kind") == "configurable", ["v"])
    got = sorted(out.collect(), key=str)
    expected = [(1, None, "configurable", 5.0, None), (1, None, "configurable", 6.0, None), (3, None, "simple", 7.0, None), (4, 9, "simple", 8.0, None),
                (None, None, "simple", 1.0, None), *[(2, 1, "simple", v, v) for v in (5.0, 6.0) for _ in range(2)]]
    assert got == sorted(map(tuple, expected), key=str)
    assert out.columns == ["id", "parent", "kind", "v", "parent_v"]
    assert "Union" in _plan(out) and "coalesce(parent" not in _plan(out)


def test_groups_are_left_out_after_joins_without_an_anti_join(spark):
    source = spark.createDataFrame([(1, "x"), (1, "bad"), (2, "x"), (None, "bad"), (None, "x"), (3, None)], "k int, sku string")
    facts = spark.createDataFrame([("x", 10)], "sku string, fact int")
    out = joins.without_groups(source.join(facts, "sku", "left"), "k", F.col("sku") == "bad", source)
    assert sorted(map(tuple, out.select("k", "sku", "fact").collect()), key=str) == sorted(
        [(2, "x", 10), (None, "bad", None), (None, "x", 10), (3, None, None)], key=str)
    plain = joins.without_groups(source.join(facts, "sku", "left"), "k", F.col("sku") == "bad")
    assert sorted(map(str, plain.collect())) == sorted(map(str, out.select(*plain.columns).collect()))
    assert "LeftAnti" not in _plan(out)
