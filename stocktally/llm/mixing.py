"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stocktally.llm.common import WORD, join_small, positions, without


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], ceiling: int) -> DataFrame:
    """(source, source_size, source_rows, target) of (source, source_size, source_rows).

    The sources, ordered by code point with null last, get the weights in turn and share the sum of all sizes. A
    target stops at ceiling times its source's size; the excess goes to the others by weight until none is above.
    Sorted by (ceiling x size / weight), the stopped sources are a prefix: the first k for which the rest, shared
    by the weights left, stays below the next one's bound. The windows run over one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")).cast("long")
    s = sizes.withColumn("weight", weight).withColumn("bound", ceiling * F.col("source_size"))
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    s = (
        s.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(earlier), F.lit(0)))
        .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        # This source and all later ones stay below their bounds if this one does.
        .withColumn("fits", F.col("bound").cast("double") >= F.col("weight") * F.col("left") / F.col("open").cast("double"))
    )
    first = Window.partitionBy(F.lit(0)).orderBy(~F.col("fits"), F.col("bound") / F.col("weight"), F.col("weight"), F.col("source").asc_nulls_last())
    level = {c: F.first(c).over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for c in ("left", "open")}
    share = F.col("weight") * level["left"] / level["open"].cast("double")
    return s.select("source", "source_size", "source_rows", F.when(F.col("fits"), share).otherwise(F.col("bound").cast("double")).alias("target"))


def mix_sources(docs: DataFrame, *, weights: list[int] = [5, 2, 1], ceiling: int = 3, seed: int = 0, per_bucket: int = 2_000) -> DataFrame:
    """docs with size, source_size, target, copies and taken.

    Every document of a source has the same expected number of copies, target / source_size. Documents of a source
    are laid out in a fixed order (hash buckets, by size within each, so that sizes are spread evenly), their
    expected copies are summed along it, one offset per source is added, and a document is taken once for each
    integer that its stretch crosses. The offset is a digest of seed and source: reruns agree.

    A null source is a source of its own, null and empty texts have size 0 and may be taken without adding words;
    repeated rows take part each by itself; an empty table gives an empty result. A source without words has target
    0. Input columns of the new names are replaced.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    docs = without(docs, new)
    sized = docs.withColumn("size", n_words("text"))
    totals = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")), weights, ceiling
    ).select(_key("source").alias("__source"), "source_size", "target")
    placed = positions(
        sized.withColumn("__source", _key("source")), ["__source"], [F.col("size"), F.col("doc_id")], ["doc_id"], "__position", per_bucket
    )
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    upto = lambda k: F.floor(k * F.col("__each") + F.col("__offset"))
    joined = join_small(placed, totals, "__source").withColumns({"__each": each, "__offset": offset})
    copies = (upto(F.col("__position") + 1) - upto(F.col("__position"))).cast("long")
    return joined.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).select(
        *[F.col(f"`{c}`") for c in docs.columns], *new
    )


def _key(source: str) -> Column:
    """Null and text as one text key that is never null."""
    return F.when(F.col(source).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(source).cast("string")))


def emit_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each taken document as often as it has copies."""
    return mixed.filter(F.col("copies") > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)
