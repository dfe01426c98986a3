"""Window operators that stay bounded when one key dominates the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stocktally.session import PARTITION_SHIFT, cut_lineage

_RANK = "__rank"


def top_per_key(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column], n: int) -> DataFrame:
    """First n rows per key in the given order.

    A rank filter over row_number: Spark inserts a limit per key and map task ahead
    of the shuffle, so at most n rows per key and task move.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) <= n).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    return top_per_key(df, keys, order_by, 1)


def previous_value(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, out: str, tiebreak: Sequence[str] = (),
) -> DataFrame:
    """lag(value) per key in ascending time, NULL times last.

    The rows are sorted by key and time over all tasks, and each task's stretch is a
    slice: its size is bounded, whatever one key or one day holds. The sorted rows are
    written once, so that both passes see the same slices. The first row of a key in a
    slice continues with the last row of the slice before if that has the same key; this
    needs one row per slice.
    """
    ordered = df.orderBy(*keys, F.col(ts).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak])
    ordered = cut_lineage(ordered.withColumn("__place", F.monotonically_increasing_id()), "sliced", "zstd")
    ordered = ordered.withColumn("__slice", F.shiftright("__place", PARTITION_SHIFT))
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    ends = ordered.groupBy("__slice").agg(F.max_by(F.struct(key.alias("key"), F.col(value).alias("value")), "__place").alias("__end"))
    before = Window.orderBy("__slice")
    carried = ends.select("__slice", F.lag("__end").over(before).alias("__carried"))
    inner = Window.partitionBy("__slice", *keys).orderBy("__place")
    first = F.row_number().over(inner) == 1
    continues = F.col("__carried").isNotNull() & F.col("__carried")["key"].eqNullSafe(key)
    return (
        ordered.withColumns({"__first": first, "__lag": F.lag(value).over(inner)})
        .join(F.broadcast(carried), "__slice")
        .withColumn(out, F.when(F.col("__first"), F.when(continues, F.col("__carried")["value"])).otherwise(F.col("__lag")))
        .drop("__slice", "__place", "__first", "__lag", "__carried")
    )


def with_group(df: DataFrame, keys: Sequence[str], *values: Column) -> DataFrame:
    """Aggregates of each row's group, pre-aggregated and joined back. Null keys form groups, as in a window."""
    totals = df.groupBy(*keys).agg(*values).withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(totals, reduce(lambda a, b: a & b, on), "inner").drop(*[f"__{k}" for k in keys])


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """value / sum(value) per group, by a pre-aggregated total joined back."""
    shares = with_group(df, keys, F.sum(value).alias("__total"))
    return shares.withColumn(out, F.col(value) / F.nullif(F.col("__total"), F.lit(0))).drop("__total")


def count_of_group(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """count(*) per group on every row, by a pre-aggregated count joined back."""
    return with_group(df, keys, F.count(F.lit(1)).alias(out))


def trailing(
    series: DataFrame, keys: Sequence[str], order: str, value: str,
    first: int, last: int, stats: dict[str, str],
) -> DataFrame:
    """Frame statistics over rows [first, last] relative to the current one.

    Meant for calendar series that are already aggregated to one row per key and
    day, so a window holds at most the days of the calendar.
    """
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order).rowsBetween(first, last)
    functions = {"avg": F.avg, "sum": F.sum, "count": F.count, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    return series.withColumns({name: functions[kind](value).over(w) for name, kind in stats.items()})


def running_total(series: DataFrame, keys: Sequence[str], order: str, value: Column, out: str) -> DataFrame:
    """Cumulative sum along a calendar series."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return series.withColumn(out, F.sum(value).over(w))


def top_n_else_other(
    df: DataFrame, member: str, value: str, n: int, out: str = "bucket", other: str = "Other",
) -> DataFrame:
    """Label each row with its member when that member ranks in the top n by total."""
    totals = df.filter(F.col(value) > 0).groupBy(member).agg(F.sum(value).alias("__total"))
    rank = Window.orderBy(F.col("__total").desc())
    leaders = (
        totals.withColumn(_RANK, F.rank().over(rank)).filter(F.col(_RANK) <= n)
        .select(F.col(member).alias("__leader"))
    )
    return (
        df.join(leaders, F.col(member) == F.col("__leader"), "left")
        .withColumn(out, F.coalesce(F.col("__leader").cast("string"), F.lit(other)))
        .drop("__leader")
    )


def session_pairs(
    events: DataFrame, key: str, ts: str, kind: str, opens: str, closes: str, tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Seconds between an opening event and the closing event that directly follows it.

    Seen from the closing event: the pair exists when the previous event of the key
    is an opening one, so the sliced previous_value works without a full-key window.
    """
    marks = events.filter(F.col(kind).isin(opens, closes)).select(
        key, ts, kind, *tiebreak, F.struct(F.col(kind).alias("k"), F.col(ts).alias("t")).alias("__mark")
    )
    paired = previous_value(marks, [key], ts, "__mark", "__prev", tiebreak)
    seconds = F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(F.col("__prev")["t"].cast("timestamp"))
    is_pair = (F.col(kind) == closes) & (F.col("__prev")["k"] == opens)
    return paired.groupBy(key).agg(
        F.count_if(F.col(kind) == opens).alias("resume_count"),
        F.avg(F.when(is_pair, seconds)).alias("avg_active_sec"),
        F.min(F.when(is_pair, seconds)).alias("min_active_sec"),
        F.max(F.when(is_pair, seconds)).alias("max_active_sec"),
    )


def decreasing_steps(df: DataFrame, value: str, order: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows whose value is lower than that of the row just before them in time."""
    keyed = df.withColumn("__all", F.lit(1))
    stepped = previous_value(keyed, ["__all"], order, value, "previous_value", tiebreak)
    return stepped.filter(F.col(value) < F.col("previous_value")).drop("__all")
