"""Writing tables: replace, append, merge by key, archive, export."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from stocktally.plans.quality import Expectation, ExpectationFailed, Finding, observed
from stocktally.session import cut_lineage
from stocktally.sources.versions import Version, add_rows, commit, commit_rows, part_of, read_version, version


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Replace or append a parquet table. A replace rewrites every partition."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = gathered(df, *partition_by).write.mode(mode).partitionBy(*partition_by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.parquet(path)


def gathered(df: DataFrame, *partition_by: str) -> DataFrame:
    """The rows of a partition in one task, those of a large one in several: else every task writes a file for each partition."""
    return df.hint("rebalance", *partition_by)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def export_parquet(df: DataFrame, path: str, compression: str = "snappy") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there. Whatever else goes wrong in looking is an error, not a missing table."""
    fs, folder = _hadoop(spark, path)
    return fs.exists(folder)


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys of which a null equals a null. Semi and anti joins only."""
    right = right.select(*[F.col(k).alias(f"__{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(right, reduce(lambda a, b: a & b, on), how)


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch. A null key part equals a null.

    Only the batch's keys travel to the target side, so the target is not sorted by
    row content and a small batch is broadcast.
    """
    return _same_key(target, batch, keys, "left_anti").unionByName(batch, allowMissingColumns=True)


def current(spark: SparkSession, path: str) -> Version | None:
    """The committed version of a table. A plain parquet folder has none."""
    return version(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table as its last commit left it; a plain parquet folder as it lies there."""
    at = current(spark, path)
    return spark.read.parquet(path) if at is None else read_version(spark, path, at)


def replace_table(spark: SparkSession, df: DataFrame, path: str, partition_by: str | None = None, checks: Sequence[Expectation] = ()) -> list[Finding]:
    """Commit df as the whole table, after the version that is current when the write begins.

    Checks are counted by the job that writes the rows; a broken one of severity error stops before the commit.
    """
    after = current(spark, path)
    return checked_commit(spark, path, df, after, checks, partition_by=partition_by)


def checked_commit(
    spark: SparkSession, path: str, df: DataFrame, after: Version | None, checks: Sequence[Expectation] = (), **how,
) -> list[Finding]:
    """commit() with expectations that are counted while the rows are written, in the same scan.

    Raises ExpectationFailed before the commit if one of severity error is broken: the table stays as it was.
    """
    watched, findings = observed(df, checks)
    fresh = add_rows(spark, path, watched, how.get("partition_by"))
    found = findings()
    broken = [f for f in found if f.status == "error"]
    if broken:
        raise ExpectationFailed(path, broken)
    commit_rows(spark, path, fresh, df.schema, after, **how)
    return found


def read_merged(spark: SparkSession, path: str, like: DataFrame, partition_by: str | None = None) -> DataFrame:
    """A merged table. In a plain folder the partition column keeps the type it has in `like`, so that 01 stays text."""
    at = current(spark, path)
    if at is not None:
        return read_version(spark, path, at)
    found = spark.read.parquet(path)
    if partition_by is None:
        return found
    kind = like.schema[partition_by].dataType
    return spark.read.schema(T.StructType([T.StructField(f.name, kind if f.name == partition_by else f.dataType) for f in found.schema])).parquet(path)


def merge_by_key(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_by: str | None = None, checks: Sequence[Expectation] = (),
) -> list[Finding]:
    """Upsert a batch into a table and commit the result as its next version.

    With a partition column only touched partitions are read and written: those of the batch and those that hold
    older rows of its keys; the others stay by reference. Readers see the table before the merge or after it. If
    another writer commits meanwhile, this merge raises ConcurrentWrite and changes nothing: run it again. The same
    batch again gives the same table. A plain parquet folder becomes a versioned table with its first merge.

    Null key parts match each other. A key that the batch holds twice is an error, as is a folder that is there but
    cannot be read as a table: nothing is written then. `checks` are counted on the rows written.
    """
    batch = cut_lineage(batch, "batch")
    twice = batch.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"the batch holds a key more than once: {twice[0].asDict()}")
    after = current(spark, path)
    if after is None:
        whole = merged(read_merged(spark, path, batch, partition_by), batch, keys) if table_exists(spark, path) else batch
        return checked_commit(spark, path, gathered(whole, partition_by) if partition_by else whole, None, checks, partition_by=partition_by)
    if after.partition_by != partition_by:
        raise ValueError(f"{path} is partitioned by {after.partition_by}, not by {partition_by}")
    if partition_by is None:
        return checked_commit(spark, path, merged(read_version(spark, path, after), batch, keys), after, checks)
    # Key and partition columns only: a narrow scan of the target. One row per partition reaches the driver.
    part = part_of(partition_by).alias("__p")
    held = _same_key(read_version(spark, path, after).select(*keys, part), batch, keys, "left_semi").select("__p")
    touched = {r[0] for r in held.union(batch.select(part)).distinct().collect()}
    result = merged(read_version(spark, path, after, sorted(touched)), batch, keys)
    return checked_commit(spark, path, gathered(result, partition_by), after, checks, partition_by=partition_by, keep=lambda p: p not in touched)


def write_bucketed(df: DataFrame, table: str, by: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store df as a catalog table in buckets of its keys, sorted by them, one file per bucket; gives the table.

    Tables bucketed alike on the columns of a join or a grouping need no exchange for it. With a path the files lie there.
    """
    writer = df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def merge_sql(target: str, source: str, keys: Sequence[str]) -> str:
    """MERGE statement for table formats that support it."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return f"MERGE INTO {target} t USING {source} s ON {on} WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"


def archive_then_overwrite(
    spark: SparkSession, current_path: str, history_path: str, new_rows: DataFrame, type_column: str, type_value: str, archived_at: str,
) -> None:
    """Copy the current rows of a type to the history table, then replace them; each step is one commit.

    Other types in the same table keep their rows. A run with a stamp that the history already holds for the type
    archives nothing again, so a run that stopped between the two commits can be repeated.
    """
    stamp = F.lit(archived_at).cast("timestamp")
    kind = F.col(type_column) == type_value
    now, past = current(spark, current_path), current(spark, history_path)
    part = spark.range(1).select(F.lit(type_value).alias(type_column)).select(part_of(type_column)).first()[0]
    if now is not None:
        rows = read_version(spark, current_path, now, [part])
        done = past is not None and not read_version(spark, history_path, past, [part]).filter(F.col("archived_at") == stamp).isEmpty()
        if not done and not rows.isEmpty():  # else a run with this stamp has archived already, or there is nothing yet
            commit(spark, history_path, rows.withColumn("archived_at", stamp), past, type_column, add=True)
    commit(spark, current_path, new_rows.filter(kind), now, type_column, keep=lambda p: p != part)
