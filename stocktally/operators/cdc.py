"""Change-log cleaning: one live row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stocktally.functions.scalars import cdc_order_ts
from stocktally.operators.windows import first_per_key

# Change-record metadata columns of the landing tables.
DELETED = "_ab_cdc_deleted_at"
UPDATED = "_ab_cdc_updated_at"
EXTRACTED = "_airbyte_extracted_at"
METADATA = (
    DELETED, UPDATED, EXTRACTED, "_ab_cdc_cursor", "_ab_cdc_log_pos", "_ab_cdc_log_file",
    "_airbyte_raw_id", "_airbyte_meta", "_airbyte_generation_id",
)


def landing_order(df: DataFrame) -> list[Column]:
    """Newest-first ordering of a landing table, with the log position as tiebreak."""
    if UPDATED in df.columns:
        order = [cdc_order_ts(UPDATED, EXTRACTED).desc_nulls_last()]
    else:
        order = [F.col(EXTRACTED).desc_nulls_last()]
    ties = ("_ab_cdc_log_pos", "_ab_cdc_cursor", EXTRACTED, "_airbyte_raw_id")
    return order + [F.col(c).desc_nulls_last() for c in ties if c in df.columns]


def cdc_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] | None = None,
    tombstone: Column | None = None,
    tombstone_mode: str = "filter_first",
    drop_null_keys: bool = False,
) -> DataFrame:
    """Newest live version per key.

    filter_first: delete records are ignored, so a deleted key falls back to its
    last live version. latest_wins: a key whose newest record is a delete is gone.
    The rank filter lets Spark keep only one candidate per key and map task before
    the shuffle, so a key holding a large share of the log stays cheap.
    """
    order = list(order_by) if order_by is not None else landing_order(df)
    if tombstone is None and DELETED in df.columns:
        tombstone = F.col(DELETED).isNotNull()
    if drop_null_keys:
        for key in keys:
            df = df.filter(F.col(key).isNotNull())
    if tombstone is None:
        return first_per_key(df, keys, order)
    dead = F.coalesce(tombstone, F.lit(False))
    if tombstone_mode == "filter_first":
        return first_per_key(df.filter(~dead), keys, order)
    if tombstone_mode != "latest_wins":
        raise ValueError(f"unknown tombstone_mode {tombstone_mode!r}")
    return first_per_key(df, keys, order).filter(~dead)


def versions_per_key(df: DataFrame, keys: Sequence[str], tombstone: Column) -> DataFrame:
    """Number of records and of delete records per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("versions"), F.count_if(tombstone).alias("tombstones")
    )
