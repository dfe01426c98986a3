"""What the operators share: words, bounded batches, shared files, dense positions, labelled samples."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from stocktally.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"  # as bytes.split() cuts UTF-8
CHUNK_BYTES = 2 << 20  # text that one numpy step holds
BROADCAST_ROWS = 200_000  # rows of a narrow table that may be broadcast


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns an operator is about to write; names are compared without case, as Spark does."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def chunks(sizes: np.ndarray, most: int = CHUNK_BYTES, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes; a longer row stands alone."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (held + size > most or i - start >= rows):
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def release() -> None:
    """Give freed memory back: a worker is used again by later tasks, beside an executor of bounded size."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def text_sizes(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)


def with_columns(
    df: DataFrame, text: str, schema: str, compute: Callable[[list[str | None]], list], *, keep: list[str] | None = None,
    most: int = CHUNK_BYTES,
) -> DataFrame:
    """The kept columns of df (all by default) and those that compute() makes of lists of texts.

    compute gets texts of one partition, about `most` bytes at a time, and returns one list or array for
    each field of schema. An input column of a new column's name is replaced.
    """
    fields = T.StructType.fromDDL(schema)
    df = df.withColumn("__text", F.col(f"`{text}`"))
    kept = without(df, ["__text", *fields.names])
    if keep is not None:
        kept = kept.select(*keep)
    names = kept.columns
    source = df.select(*[F.col(f"`{c}`") for c in names], "__text")
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for a, b in chunks(text_sizes(texts), most):
                made = compute(texts.slice(a, b - a).to_pylist())
                arrays = [batch.column(i).slice(a, b - a) for i in range(len(names))]
                arrays += [m if isinstance(m, pa.Array) else pa.array(m, t) for m, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [*names, *fields.names])
            release()

    out = T.StructType([*kept.schema.fields, *[T.StructField(f.name, f.dataType, True) for f in fields]])
    return source.mapInArrow(run, out)


class Words:
    """Words of a list of texts as ids of distinct words, in order. A null text has none."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        ids: dict[bytes, int] = defaultdict(count().__next__)
        parts, lengths = [], []
        for t in texts:
            words = ((t.lower() if lower else t).encode("utf-8", "surrogatepass").split() if t else [])
            lengths.append(len(words))
            parts.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
        self.ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1].astype(np.int64)
        self.docs = np.repeat(np.arange(len(texts)), self.lengths)
        self.distinct = list(ids)

    def bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of the distinct words, each word between zero bytes, and the place of each word's first zero."""
        sizes = np.fromiter(map(len, self.distinct), np.int64, len(self.distinct))
        joined = b"\0" + b"\0".join(self.distinct) + b"\0" if self.distinct else b"\0"
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        return np.frombuffer(joined, np.uint8), starts.astype(np.int64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text: the sum over its words of a value (or row) of each distinct word."""
        out = np.zeros((len(self.lengths), *values.shape[1:]), np.float64)
        if len(self.ids):
            some = self.lengths > 0
            out[some] = np.add.reduceat(values[self.ids].astype(np.float64), self.starts[some], axis=0)
        return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.crc32(doc_id.cast("string")) % folds


def bounded_sample(df: DataFrame, key: str, most: int, by: str | None = None, content: str | None = None) -> DataFrame:
    """About `most` different rows at most (of each value of `by`); all different rows if there are fewer.

    Rows are different if key or content is; they are chosen by a hash of both, so that many rows of one key, or
    without a key, are drawn one by one. Of equal rows one is left. `by` has one group per class.
    """
    columns = df.columns
    by_column = F.col(by) if by else F.lit(0)
    what = [F.col(f"`{key}`"), *([F.col(f"`{content}`")] if content else [])]
    drawn = df.withColumns({"__x": F.xxhash64(F.lit(7), *what), "__y": F.xxhash64(F.lit(8), *what)})
    sizes = drawn.groupBy(by_column.alias("k")).agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("__x", 0.01).alias("different")).collect()
    share = F.lit(1.0)
    for row in sizes:
        if min(row["rows"], row["different"]) > most:
            share = F.when(by_column.eqNullSafe(F.lit(row["k"])), F.lit(most / row["different"])).otherwise(share)
    spread = F.pmod(F.col("__x"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return drawn.filter(spread < share).dropDuplicates(["__x", "__y", *([by] if by else [])]).select(*[F.col(f"`{c}`") for c in columns])


def labelled_ids(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(__id, __label, __fold) of labels outside the held-out fold, one row per id: its largest label."""
    return (
        labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label")).dropna()
        .withColumn("__fold", fold_of(F.col("__id"), folds)).filter(F.col("__fold") != held_out)
        .groupBy("__id", "__fold").agg(F.max("__label").alias("__label"))
    )


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, __text, __label, __fold) of a bounded sample of labelled rows outside the held-out fold.

    The ids of the sample are broadcast: `most` rows per class bound them, so that no text is shuffled. Rows are bounded
    once more after the join, for ids that have many rows. A doc_id labelled more than once counts with its largest
    label; null labels are left out.
    """
    ids = bounded_sample(labelled_ids(labels, label, folds, held_out), "__id", most, "__label")
    rows = (
        docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")).filter(F.col("__text").isNotNull())
        .join(F.broadcast(ids), "__id").withColumnRenamed("__id", "doc_id")
    )
    return bounded_sample(cut_lineage(rows, "labelled"), "doc_id", most, "__label", "__text")


def join_small(big: DataFrame, small: DataFrame, on: str, how: str = "left", most: int = BROADCAST_ROWS) -> DataFrame:
    """Join a narrow table that is expected to be small: broadcast if it is, else an adaptive shuffle join.

    The table is stored first, so that its size is known and it is computed once.
    """
    small = cut_lineage(small, "small")
    if small.count() <= most:
        small = F.broadcast(small)
    return big.join(small, on, how)


def positions(df: DataFrame, group: list[str], order: list[Column], spread: list[str], out: str, per_bucket: int = 2_000) -> DataFrame:
    """Gapless positions from 0 of the rows of each group, without one task per group.

    The rows of a group are spread by a hash over buckets of about per_bucket rows; a row's position is the
    number of rows in earlier buckets plus its rank in its own. Groups may be null.
    """
    keys = [F.col(c) for c in group]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    key = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"v{i}") for i, c in enumerate(group)], *[F.col(c).isNull().alias(f"n{i}") for i, c in enumerate(group)])
    sizes = sizes.select(key.alias("__key"), F.ceil(F.col("__n") / per_bucket).alias("__buckets"))
    digest = F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spread]))
    spread_to = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.col("__buckets")
    placed = join_small(df.withColumn("__key", key), sizes, "__key").withColumn("__bucket", spread_to).drop("__buckets")
    before = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("__key", "__bucket").agg(F.count(F.lit(1)).alias("__rows")).select(
        F.struct("__key", "__bucket").alias("__slot"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    rank = F.row_number().over(Window.partitionBy("__key", "__bucket").orderBy(*order))
    placed = placed.withColumn("__rank", rank).withColumn("__slot", F.struct("__key", "__bucket"))
    return join_small(placed, offsets, "__slot").withColumn(out, F.col("__offset") + F.col("__rank") - 1).drop(
        "__key", "__bucket", "__slot", "__offset", "__rank"
    )


def collected(df: DataFrame) -> pa.Table:
    """A small result in the driver. Only for frames whose size a parameter bounds."""
    return df.toArrow()


class Shared:
    """A value of bounded size, sent to each executor once. Tasks read it as .value.

    A Python worker unpacks it once and keeps it, with what .kept() made of it, while it serves tasks that use it:
    both hang on the broadcast, which the worker holds between tasks.
    """

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        held = self._sent.__dict__
        if "_held" not in held:
            held["_held"] = cloudpickle.loads(self._sent.value)
        return held["_held"]

    def kept(self, make: Callable):
        """make(value), once for each worker."""
        held = self._sent.__dict__
        if "_made" not in held:
            held["_made"] = make(self.value)
        return held["_made"]
