"""Incremental processing with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from stocktally.operators.cdc import DELETED, cdc_latest
from stocktally.operators.windows import first_per_key
from stocktally.sources.sinks import current, merge_by_key, read_merged, table_exists
from stocktally.sources.versions import part_of, read_version


def cdc_stream_upsert(
    stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str,
    clean: Callable[[DataFrame], DataFrame] | None = None, newest_first: Callable[[], Sequence[Column]] | None = None,
    partition_by: str | None = None, fixed_partition: bool = False, once: bool = True, tombstone: Callable[[], Column] | None = None, tombstone_mode: str = "filter_first",
) -> StreamingQuery:
    """Upsert newly arriving change records into a parquet table.

    A batch is cleaned to one row per key before it meets the table. With
    `newest_first` the stored rows of the batch's keys take part in that choice, so
    a late, older record never replaces a newer one. Replaying a batch after a
    failure writes the same rows again, so the result does not change.

    With fixed_partition a key never changes its partition, as when a bucket of the key is the partition: then only the
    partitions that a batch touches are read. `keyed.keyed_upsert` reads none.

    filter_first ignores delete records, as the batch operator does. latest_wins keeps
    the newest record of a key even if it is a delete, marked in `is_deleted`: an older
    record that comes later does not bring the key back. `live_rows` reads the others.
    """
    if tombstone_mode not in ("filter_first", "latest_wins"):
        raise ValueError(f"unknown tombstone_mode {tombstone_mode!r}")
    if tombstone_mode == "latest_wins" and (clean or newest_first is None):
        raise ValueError("latest_wins ranks deletes itself: give newest_first and no clean")

    def apply(batch: DataFrame, _batch_id: int) -> None:
        dead = tombstone() if tombstone else F.col(DELETED).isNotNull() if DELETED in batch.columns else None
        if tombstone_mode == "latest_wins":
            flag = F.lit(False) if dead is None else F.coalesce(dead, F.lit(False))
            rows = first_per_key(batch.withColumn("is_deleted", flag), keys, newest_first())
        else:
            rows = clean(batch) if clean else cdc_latest(batch, keys, newest_first and newest_first(), dead)
        session = batch.sparkSession
        if newest_first and table_exists(session, path):
            ids = rows.select(*keys).distinct()
            at = current(session, path)
            if fixed_partition and at is not None and partition_by:
                touched = [r[0] for r in rows.select(part_of(partition_by)).distinct().collect()]  # folders that are written too
                stored = read_version(session, path, at, touched)
            else:
                stored = read_merged(session, path, rows, partition_by)
            known = stored.join(ids, list(keys), "left_semi")
            rows = first_per_key(rows.unionByName(known), keys, newest_first())
        merge_by_key(session, path, rows, keys, partition_by)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def live_rows(table: DataFrame) -> DataFrame:
    """Rows of a table kept with latest_wins whose newest record is no delete."""
    return table.filter(~F.col("is_deleted")).drop("is_deleted")


def daily_distinct(stream: DataFrame, ts: str, order: str, by: Sequence[str] = (), late: str = "3 days") -> DataFrame:
    """Approximate distinct orders per day, with late records accepted for a while."""
    return (
        stream.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w"), *by)
        .agg(F.approx_count_distinct(order, 0.02).alias("orders"), F.count(F.lit(1)).alias("records"))
        .select(F.col("w.start").cast("date").alias("sale_date"), *by, "orders", "records")
    )


def exact_daily_distinct(stream: DataFrame, ts: str, order: str, late: str = "3 days") -> DataFrame:
    """First record of every (day, order): counting its rows per day is exact."""
    keyed = stream.withColumn("sale_date", F.col(ts).cast("date")).withWatermark(ts, late)
    return keyed.dropDuplicatesWithinWatermark(["sale_date", order])


def stream_ages(stream: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest record time per stream; complete-mode state is one row per stream name."""
    return stream.groupBy(*keys).agg(F.max(ts).alias("last_extracted_at"), F.count(F.lit(1)).alias("records"))


def drain(df: DataFrame, folder: str, mode: str) -> DataFrame:
    """Run a bounded stream to its end and read its result from files.

    An appended result is written as a file sink. A complete one replaces the files of the trigger before.
    """
    if mode == "append":
        writer = df.writeStream.format("parquet").outputMode(mode).option("path", folder)
    else:
        writer = df.writeStream.outputMode(mode).foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(folder))
    writer.option("checkpointLocation", folder + "-progress").trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(folder)
