"""Distinct counts that can be added up: one sketch per day and group, merged for any span."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stocktally.sources.sinks import merge_by_key, read_table, table_exists

LG_K = 14  # 2^14 registers, at most 16 KB a sketch
ERROR = 3 * 1.04 / (1 << LG_K) ** 0.5  # three standard errors of an estimate, 2.4 %


def daily_sketches(rows: DataFrame, day: Column, value: str, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """(day, by, records, sketch): a sketch of the distinct values of each day and group. Nulls are no value.

    Sketches are built map-side and merged after the shuffle, so a day with most of the rows is no single task's work.
    """
    return rows.groupBy(day.alias("day"), *by).agg(F.count(F.lit(1)).alias("records"), F.hll_sketch_agg(value, lg_k).alias("sketch"))


def distinct_over(sketches: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Estimated distinct values and records of any grouping of the days and groups; values seen in several count once."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"), F.sum("records").alias("records"))


def store_sketches(spark: SparkSession, path: str, sketches: DataFrame, by: Sequence[str] = ()) -> None:
    """Keep sketches beside a table: days that come again replace themselves, others are not read. Partitioned by month."""
    merge_by_key(spark, path, sketches.withColumn("month", F.date_format("day", "yyyy-MM")), ["day", *by], "month")


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        raise FileNotFoundError(path)
    return read_table(spark, path).drop("month")
