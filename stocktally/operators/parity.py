"""Comparison of two copies of a change-log table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.operators.ordering import two_way_difference
from stocktally.session import cut_lineage


def table_parity(
    left: DataFrame, right: DataFrame, key: str, ts: str, left_live: DataFrame, right_live: DataFrame, tombstone: Column,
) -> DataFrame:
    """One row: live counts, newest times and lag, tombstones, ids on one side only.

    left/right are the raw logs, *_live their cleaned rows.
    """
    def side(raw: DataFrame, live: DataFrame, name: str) -> DataFrame:
        facts = raw.agg(F.max(ts).alias("newest"), F.count_if(tombstone).alias("tombs"))
        rows = live.agg(F.count(F.lit(1)).alias("rows"))
        both = facts.crossJoin(F.broadcast(rows))  # one row each
        return both.select(*[F.col(c).alias(f"{name}_{c}") for c in ("rows", "newest", "tombs")])

    only = two_way_difference(left_live, right_live, key).agg(
        F.count_if(F.col("only_in") == "left").alias("in_left_only"), F.count_if(F.col("only_in") == "right").alias("in_right_only")
    )
    merged = side(left, left_live, "left").crossJoin(F.broadcast(side(right, right_live, "right"))).crossJoin(F.broadcast(only))
    seconds = F.unix_seconds(F.col("left_newest").cast("timestamp")) - F.unix_seconds(F.col("right_newest").cast("timestamp"))
    gap = F.col("left_rows") - F.col("right_rows")
    return merged.select(
        "left_rows", "right_rows", gap.alias("row_diff"),
        F.round(F.coalesce(F.abs(gap) / F.nullif(F.col("left_rows"), F.lit(0)) * 100, F.lit(0.0)), 4).alias("pct_diff"),
        seconds.alias("lag_seconds"), F.col("left_tombs").alias("left_tombstones"), F.col("right_tombs").alias("right_tombstones"),
        "in_left_only", "in_right_only",
    )


def _row_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys, digest of the keys and two digests of the whole row. Nulls count, so that a value cannot change places with one."""
    def digest(names: Sequence[str], seed: int) -> Column:
        return F.xxhash64(F.lit(seed), *[x for c in names for x in (F.col(c).isNull(), F.col(c))])

    return df.select(*keys, digest(keys, 1).alias("__key"), digest(columns, 2).alias("__a"), digest(columns, 3).alias("__b"))


def _checksums(rows: DataFrame, by: Sequence[Column]) -> DataFrame:
    """Order-free sums of row digests; they combine before the shuffle. xor alone would lose a row that comes twice."""
    halves = [F.sum(F.shiftright(c, s).bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(20,0)")) for c in ("__a", "__b") for s in (0, 32)]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), *[h.alias(f"__s{i}") for i, h in enumerate(halves)])


def _differing(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose checksums are not the same on both sides, with both row counts."""
    sums = ["__n", "__s0", "__s1", "__s2", "__s3"]
    other = right.select(*by, *[F.col(c).alias(f"{c}r") for c in sums])
    same = F.lit(True)
    for c in sums:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}r"))
    return left.join(other, list(by), "full").filter(~same)


def digest_parity(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, fan_out: int = 256, depth: int = 2,
) -> DataFrame:
    """Keys whose rows differ between two copies of a table: keys, left_rows, right_rows, state.

    state is left_only, right_only or changed (other values, or another number of rows). `columns` are compared, by
    default all that both sides have. Rows get a 128-bit digest; its sums per bucket of keys are compared first, then
    per bucket of the buckets that differ, `depth` levels down. Only rows of leaves that differ are compared by key, so
    two equal copies cost one scan each and no shuffle of rows. fan_out buckets a level bound what reaches the driver
    (the last level stays in a table). Null keys are keys, and rows may repeat; order does not matter.
    """
    names = list(columns) if columns is not None else [c for c in left.columns if c in set(right.columns)]
    names = [*keys, *[c for c in names if c not in keys]]
    sides = [_row_digests(df.select(*names), keys, names) for df in (left, right)]
    # Which buckets of the level above differ: a filter on a list of at most fan_out numbers, then a small table.
    level = F.pmod(F.col("__key"), F.lit(fan_out)).alias("__bucket")
    found = _differing(*[_checksums(s, [level]) for s in sides], ["__bucket"]).select("__bucket")
    wanted = [r[0] for r in found.collect()]
    sides = [s.filter(F.pmod(F.col("__key"), F.lit(fan_out)).isin(wanted)) for s in sides]
    for d in range(2, depth + 1):
        leaf = F.pmod(F.col("__key"), F.lit(fan_out**d)).alias("__bucket")
        found = cut_lineage(_differing(*[_checksums(s, [leaf]) for s in sides], ["__bucket"]).select("__bucket"), "differing")
        sides = [s.withColumn("__bucket", leaf).join(found, "__bucket", "left_semi").drop("__bucket") for s in sides]
    facts = [_checksums(s, [F.col("__key")]) for s in sides]
    differ = _differing(*facts, ["__key"]).select("__key", F.coalesce("__n", F.lit(0)).alias("left_rows"), F.coalesce("__nr", F.lit(0)).alias("right_rows"))
    named = sides[0].select("__key", *keys).unionByName(sides[1].select("__key", *keys)).join(differ.select("__key"), "__key", "left_semi").dropDuplicates(["__key"])
    state = F.when(F.col("right_rows") == 0, "left_only").when(F.col("left_rows") == 0, "right_only").otherwise("changed")
    return named.join(differ, "__key").select(*keys, "left_rows", "right_rows", state.alias("state"))
