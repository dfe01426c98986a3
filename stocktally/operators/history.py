"""Validity-interval history of a changing table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

FROM, TO = "valid_from", "valid_to"


def scd2_check(
    current: DataFrame, history: DataFrame | None, key: str, check_cols: Sequence[str], as_of: str, invalidate_deleted: bool = True,
) -> DataFrame:
    """New history after comparing a snapshot with the open rows.

    An unchanged key keeps its open row, a changed one is closed and opened again, a
    vanished one is closed. Closed rows pass through without a join.
    """
    at = F.lit(as_of).cast("timestamp")
    open_end = F.lit(None).cast("timestamp")
    fresh = current.withColumns({FROM: at, TO: open_end})
    if history is None:
        return fresh
    closed, live = history.filter(F.col(TO).isNotNull()), history.filter(F.col(TO).isNull())
    pair = live.select(key, F.struct(*live.columns).alias("old")).join(
        current.select(key, F.struct(*current.columns).alias("new")), key, "full_outer"
    )
    differs = F.lit(False)
    for column in check_cols:
        differs = differs | ~F.col(f"old.{column}").eqNullSafe(F.col(f"new.{column}"))
    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = had & has & differs
    ends = changed | (had & ~has) if invalidate_deleted else changed
    values = [c for c in current.columns]
    carried = pair.filter(had).select(
        *[F.col(f"old.{c}").alias(c) for c in values], F.col(f"old.{FROM}").alias(FROM), F.when(ends, at).alias(TO)
    )
    opened = pair.filter(has & (~had | changed)).select(
        *[F.col(f"new.{c}").alias(c) for c in values], at.alias(FROM), open_end.alias(TO)
    )
    return closed.select(*values, FROM, TO).unionByName(carried).unionByName(opened)


def as_of(history: DataFrame, day: str) -> DataFrame:
    """Rows valid at a moment."""
    at = F.lit(day).cast("timestamp")
    return history.filter((F.col(FROM) <= at) & ((F.col(TO) > at) | F.col(TO).isNull()))


# Columns watched and kept by the segment snapshot.
SEGMENT_CHECK = ("customer_classification", "frequency", "recency", "value", "margin_classification")
SEGMENT_COLUMNS = (
    "rank_id", "customer_email", *SEGMENT_CHECK, "monetary_value", "number_of_purchases", "total_revenue",
    "days_since_last_purchase", "customer_group",
)


def segment_snapshot(segments: DataFrame, history: DataFrame | None, as_of_ts: str) -> DataFrame:
    return scd2_check(segments.select(*SEGMENT_COLUMNS), history, "customer_email", SEGMENT_CHECK, as_of_ts)
