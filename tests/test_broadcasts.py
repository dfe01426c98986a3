"""Broadcasts of the table model follow measured sizes, not file sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktally.session import RUNTIME_CONF, tune_model


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_small_file_of_many_rows_is_not_broadcast_by_its_file_size(spark, tmp_path):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", *RUNTIME_CONF)
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        tune_model(spark)
        spark.range(300_000).selectExpr("id as k", "id % 7 as v").coalesce(1).write.parquet(f"{tmp_path}/side")
        side = spark.read.parquet(f"{tmp_path}/side")
        big = spark.range(1_000).select(F.col("id").alias("k"))
        joined = big.repartition(2).join(side, "k", "left")
        assert "BroadcastHashJoin" not in _plan(joined)
        assert joined.agg(F.count("v")).first()[0] == 1_000
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
