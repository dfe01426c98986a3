"""Join operators. Broadcasts are left to Catalyst, which checks the side's size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from stocktally.session import cut_lineage


def without_groups(df: DataFrame, key: str, condition: Column, source: DataFrame | None = None) -> DataFrame:
    """Drop every row of a group in which any row meets the condition.

    `source` has the rows that are tested, where df is the result of joins with them. An anti join would be pushed below
    those joins and move the rows once more; the marks stay here, where the rows may already lie by key.
    """
    flagged = (df if source is None else source).filter(condition).select(key).distinct()
    if source is None:
        return df.join(flagged, key, "left_anti")
    return df.join(flagged.withColumn("__flagged", F.lit(True)), key, "left").filter(F.col("__flagged").isNull()).drop("__flagged")


def groups_with_history(df: DataFrame, keys: Sequence[str], day: str, minimum: int) -> DataFrame:
    """Keep groups that have rows on at least `minimum` distinct days."""
    eligible = (
        df.groupBy(*keys).agg(F.count_distinct(day).alias("__days"))
        .filter(F.col("__days") >= minimum).select(*keys)
    )
    return df.join(eligible, list(keys), "left_semi")


def ids_missing_from(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids on the left that the right does not have; NULL ids never match and are dropped."""
    return left.select(key).filter(F.col(key).isNotNull()).distinct().join(
        right.select(key).distinct(), key, "left_anti"
    )


def rows_on_latest(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """All rows of each key that carry the key's newest time."""
    latest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return df.join(latest, [*keys, ts], "left_semi")


def inherit_from_parent(
    df: DataFrame, key: str, parent: str, is_parent: Column, columns: Sequence[str], prefix: str = "parent_",
) -> DataFrame:
    """Self join: children of a parent row take over its measures.

    Parent measures are also kept, under a prefix.
    """
    donors = df.filter(is_parent).select(
        F.col(key).alias("__donor"), *[F.col(c).alias(prefix + c) for c in columns]
    )
    joined = df.filter(F.col(parent).isNotNull()).join(donors, F.col(parent) == F.col("__donor"), "left")
    has = F.col("__donor").isNotNull()
    children = joined.withColumns(
        {c: F.when(has, F.col(prefix + c)).otherwise(F.col(c)) for c in columns}
    ).drop("__donor")
    # A row without a parent has nothing to look up, so it does not move.
    kinds = {c: children.schema[c].dataType for c in columns}
    alone = df.filter(F.col(parent).isNull()).withColumns({
        **{c: F.col(c).cast(kind) for c, kind in kinds.items()}, **{prefix + c: F.lit(None).cast(kind) for c, kind in kinds.items()},
    })
    return children.unionByName(alone)


def with_scalar_row(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    The scalar side is an ungrouped aggregate, so it is exactly one row.
    """
    return df.join(F.broadcast(scalar), F.lit(True), "cross")


def range_lookup(df: DataFrame, value: str | Column, table: DataFrame, low: str, high: str, out: str) -> DataFrame:
    """Value of the integer range that holds `value`.

    The ranges are unrolled into their integers, which turns the range test into an
    equality join; its cost is the total width of the ranges, not rows x ranges.
    """
    points = table.select(F.explode(F.sequence(F.col(low), F.col(high))).alias("__point"), F.col(out))
    key = F.col(value) if isinstance(value, str) else value
    return df.withColumn("__v", key).join(points, F.col("__v") == F.col("__point"), "left").drop("__v", "__point")


def _number(c: Column, kind: T.DataType) -> Column:
    """Points of a time line as numbers: microseconds for times, days for dates."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return (F.unix_date(c) if isinstance(kind, T.DateType) else c).cast("double")


def interval_join(
    df: DataFrame, point: str, ranges: DataFrame, low: str, high: str, how: str = "inner", closed: str = "left", coarse: int = 2,
) -> DataFrame:
    """Rows of df with each range that holds their point: low <= point < high, or <= high with closed="both".

    A range lies in bins of the power of two that is not smaller than it, so in two bins at most, however wide it is;
    a point lies in one bin of each size that occurs. That makes an equality join on size and bin, with the exact test
    after it: no nested loop, and no unrolling of ranges. Sizes go up by `coarse` doublings, which keeps them few; they
    are the only thing that reaches the driver. A bin that holds many rows is split like any skewed key.

    Points and ranges are numbers, dates or times of one type. Null points, ranges with a null end and ranges that end
    before they begin meet nothing. how="left" keeps rows that meet nothing. df and ranges have different column names.
    """
    if how not in ("inner", "left") or closed not in ("left", "both"):
        raise ValueError(f"unknown how {how!r} or closed {closed!r}")
    start, end = (_number(F.col(c), ranges.schema[c].dataType) for c in (low, high))
    held = ranges.filter(F.col(low) <= F.col(high))
    width = F.greatest(end - start, F.lit(2.0**-40))
    held = held.withColumn("__size", (F.ceil(F.log2(width) / coarse) * coarse).cast("int"))
    sizes = sorted(r[0] for r in held.select("__size").distinct().collect())
    bin_of = lambda v, size: F.floor(v / F.pow(F.lit(2.0), size))
    held = held.withColumn("__bin", F.explode(F.array_distinct(F.array(bin_of(start, F.col("__size")), bin_of(end, F.col("__size"))))))
    rows = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()), "points") if how == "left" else df
    value = _number(F.col(point), df.schema[point].dataType)
    places = F.array(*[F.struct(F.lit(s).alias("__size"), bin_of(value, F.lit(s)).alias("__bin")) for s in sizes]).cast("array<struct<__size:int,__bin:bigint>>")
    placed = rows.filter(F.col(point).isNotNull()).select("*", F.inline(places))
    inside = (F.col(point) >= F.col(low)) & ((F.col(point) < F.col(high)) if closed == "left" else (F.col(point) <= F.col(high)))
    met = placed.join(held, ["__size", "__bin"]).filter(inside).drop("__size", "__bin")
    if how == "inner":
        return met
    alone = rows.join(met.select("__row").distinct(), "__row", "left_anti")
    return met.unionByName(alone, allowMissingColumns=True).drop("__row")


def date_axis(spark, start: str, end: str, unit: str = "day", name: str = "day") -> DataFrame:
    """One row per day or month of a fixed calendar span."""
    step = F.expr(f"interval 1 {unit}")
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), step)
    return spark.range(1).select(F.explode(days).alias(name))


def fill_axis(axis: DataFrame, frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Left join several (key, value) frames onto a date axis, missing values as zero."""
    result = axis
    for name, frame in frames.items():
        result = result.join(frame.withColumnRenamed("value", name), key, "left")
    return result.fillna(0.0, subset=list(frames))
