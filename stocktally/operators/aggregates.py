"""Aggregation helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.functions.scalars import as_col, pct


def pivot_max(df: DataFrame, keys: Sequence[str], label: str | Column, value: str | Column, columns: Mapping[object, str]) -> DataFrame:
    """One pass over a long attribute table: max(value) per label as columns."""
    lab, val = as_col(label), as_col(value)
    return df.groupBy(*keys).agg(*[F.max(F.when(lab == k, val)).alias(out) for k, out in columns.items()])


def pivot_sum(df: DataFrame, keys: Sequence[str], label: str | Column, value: str | Column, columns: Mapping[object, str]) -> DataFrame:
    """sum(value) per label as columns, zero where the label is absent."""
    lab, val = as_col(label), as_col(value)
    zero = F.lit(0)
    return df.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(lab == k, val).otherwise(zero)), zero).alias(out) for k, out in columns.items()]
    )


def ordered_text(df: DataFrame, keys: Sequence[str], value: str, separator: str, out: str) -> DataFrame:
    """Values of a group in ascending order, joined into one text.

    Repeated values are counted before the group is formed, so the shuffle carries
    one row per distinct value of a group.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).cast("int").alias("__n"))
    pairs = F.sort_array(F.collect_list(F.struct(F.col(value).alias("v"), F.col("__n").alias("n"))))
    words = F.flatten(F.transform(pairs, lambda p: F.array_repeat(p["v"], p["n"])))
    return counted.groupBy(*keys).agg(F.array_join(words, separator).alias(out))


def mean_of_means(df: DataFrame, inner: Sequence[str], outer: Sequence[str], value: str, out: str) -> DataFrame:
    """Average over outer keys of the averages over inner keys."""
    first = df.groupBy(*inner).agg(F.avg(value).alias("__m"))
    return first.groupBy(*outer).agg(F.avg("__m").alias(out))


def with_total_row(detail: DataFrame, label: str, text: str, totals: Sequence[Column]) -> DataFrame:
    """Append one total row; totals are aggregates over the detail rows."""
    total = detail.agg(*totals).withColumn(label, F.lit(text))
    return detail.unionByName(total.select(*detail.columns))


def margin_pct(revenue: str, cost: str, digits: int | None = 2) -> Column:
    """(sum revenue - sum cost) / sum revenue, in percent."""
    return pct(F.sum(revenue) - F.sum(cost), F.sum(revenue), digits)
