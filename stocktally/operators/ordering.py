"""Sorts, limits and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def top_rows(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    """First n rows in order; runs as a per-task top-k and one small merge."""
    return df.orderBy(*order_by).limit(n)


def priority(column: str, values: Sequence[object]) -> Column:
    """Sort key that follows a fixed list of values, others last."""
    expr = None
    for position, value in enumerate(values, 1):
        hit = F.col(column) == value
        expr = F.when(hit, position) if expr is None else expr.when(hit, position)
    return expr.otherwise(len(values) + 1)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of branches by column name, duplicates kept."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def labelled_stack(frames: dict[str, DataFrame], label: str, columns: Sequence[str]) -> DataFrame:
    """Union of same-shape branches, each tagged with its name."""
    return stack([f.select(F.lit(name).alias(label), *columns) for name, f in frames.items()])


def two_way_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids found on one side only, with the side's name."""
    from stocktally.operators.joins import ids_missing_from

    return stack([
        ids_missing_from(left, right, key).withColumn("only_in", F.lit("left")),
        ids_missing_from(right, left, key).withColumn("only_in", F.lit("right")),
    ])
