"""Line dedup: lines that many documents share stay in one of them only. DataFrame functions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.llm.common import BROADCAST_ROWS, join_small, without
from stocktally.session import cut_lineage

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CELLS = 1_000_000  # dropped positions that may be broadcast


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A-Z in lower case; other letters stay as they are."""
    bare = F.btrim(line, F.lit(_BLANKS))
    # lower() changes nothing but A-Z where all characters are single bytes, and is much cheaper than translate().
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _digest(*columns: Column) -> list[Column]:
    """128 bits in two columns that are never null."""
    return [F.xxhash64(F.lit(seed), *columns) for seed in (11, 23)]


def line_hashes(lines: Column, least_chars: int) -> Column:
    """For each line the MD5 of its key, null for keys shorter than least_chars."""
    return F.transform(F.transform(lines, line_key), lambda k: F.when(F.length(k) >= least_chars, F.md5(k)))


def shared_lines(marked: DataFrame, least_docs: int) -> DataFrame:
    """(__hash, __last) of line hashes in at least least_docs rows of (__id, __hashes); __last is the largest id among them.

    A row counts once for each hash, so that counts and maxima combine before the shuffle, also of a line that is in
    every document.
    """
    lines = marked.select("__id", F.explode(F.array_distinct("__hashes")).alias("__hash")).filter(F.col("__hash").isNotNull())
    counted = lines.groupBy("__hash").agg(F.count(F.lit(1)).alias("__docs"), F.max("__id").alias("__last"))
    return counted.filter(F.col("__docs") >= least_docs).drop("__docs")


def dedup_lines(docs: DataFrame, *, least_chars: int = 20, least_docs: int = 3, keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs (all by default) with n_lines, n_dropped and kept_text.

    A text is split at \\n. A line's key is the line without [\\x20\\x09-\\x0D] at both ends and with A-Z in lower case.
    Keys of at least `least_chars` code points that `least_docs` rows or more hold lose all their lines, except in the
    rows with the largest doc_id among them. Other lines stay in their order, joined by \\n; n_lines counts before.

    Lines are hashed to 128 bits within their row; only hashes are counted, joined and grouped. A text meets its
    dropped positions by a digest of id and text, in a broadcast while these are few, else in an adaptive shuffle join.
    A line of very many documents is one key of a small table; the rows that hold it are spread by skew splitting.

    A null or empty text is one empty line. Each row is a document: rows with one id count one by one, and all rows of
    the largest id keep their lines. A null id is smaller than any other; if only rows without an id hold a key, they
    all keep it. Texts of any length are taken whole. An empty table gives an empty result. Input columns of the new
    names are replaced.
    """
    kept = without(docs, ["n_lines", "n_dropped", "kept_text"])
    kept = kept if keep is None else kept.select(*keep)
    names = kept.columns
    key = [c.alias(n) for n, c in zip(("__x", "__y"), _digest(F.col("doc_id"), F.col("text")), strict=True)]
    marked = docs.select(F.col("doc_id").alias("__id"), *key, line_hashes(split_lines(F.col("text")), least_chars).alias("__hashes"))
    marked = cut_lineage(marked, "line-hashes")
    often = shared_lines(marked, least_docs)
    at = marked.select("__id", "__x", "__y", F.posexplode("__hashes").alias("__pos", "__hash")).filter(F.col("__hash").isNotNull())
    gone = join_small(at, often, "__hash", "inner").filter(~F.col("__id").eqNullSafe(F.col("__last")))
    gone = cut_lineage(gone.groupBy("__x", "__y").agg(F.collect_set("__pos").alias("__gone")), "dropped-lines")
    rows, cells = gone.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("__gone")), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and cells <= _CELLS:
        gone = F.broadcast(gone)
    whole = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("__row"), F.coalesce("text", F.lit("")).alias("__text"), *key)
    met = whole.join(gone, ["__x", "__y"], "left").withColumn("__lines", split_lines(F.col("__text")))
    met = met.withColumn("__n", F.size("__lines"))
    # The positions that stay, in order, in time linear in the lines.
    stay = F.array_except(F.sequence(F.lit(0), F.col("__n") - 1), F.col("__gone"))
    text = F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n")
    return met.select(
        *[F.col(f"__row.`{n}`").alias(n) for n in names], F.col("__n").cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(text).alias("kept_text"),
    )
