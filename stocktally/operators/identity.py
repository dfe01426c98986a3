"""Dense, ordered surrogate ids over an unbounded set of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stocktally.functions.scalars import normalized_email
from stocktally.session import PARTITION_SHIFT, cut_lineage


def dense_rank_ids(values: DataFrame, column: str, out: str) -> DataFrame:
    """1..n in ascending order of distinct values, without a single-task window.

    A range-partitioned sort gives each task a slice of the order; the position in
    the slice plus the number of rows in earlier slices is the rank. The sorted
    result is written once, so both passes see the same slices after an executor loss.
    """
    ordered = values.orderBy(column).select(
        column, F.monotonically_increasing_id().alias("__mono")
    )
    ordered = cut_lineage(ordered, "ranked").select(
        column,
        F.shiftright("__mono", PARTITION_SHIFT).alias("__slice"),
        F.col("__mono").bitwiseAND(F.lit((1 << PARTITION_SHIFT) - 1)).alias("__pos"),
    )
    # One row per task of the sort: bounded by the shuffle width.
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("__slice").agg(F.count(F.lit(1)).alias("__rows"))
        .select("__slice", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    return ordered.join(F.broadcast(offsets), "__slice").select(
        column, (F.col("__offset") + F.col("__pos") + 1).alias(out)
    )


def customer_identity(orders: DataFrame, email: str, default: str) -> DataFrame:
    """Distinct lower-case emails with dense ids in email order."""
    emails = orders.select(normalized_email(email, default).alias("customer_email")).distinct()
    return dense_rank_ids(emails, "customer_email", "rank_id")
