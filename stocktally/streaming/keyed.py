"""Streams with state per key: upserts that read no target, and alerts when a stream falls silent."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stocktally.operators.windows import first_per_key
from stocktally.sources.versions import ConcurrentWrite, add_rows, commit_rows, read_version, version

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DELETED_FLAG = "is_deleted"


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state on disk, as state with variables needs; others are left alone."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before is not None else spark.conf.unset(_STORE)


def _to_the_end(by_clock: bool) -> dict[str, bool]:
    """Trigger of a run that ends. State that follows the clock always has one more batch to come, so that is one batch."""
    return {"once": True} if by_clock else {"availableNow": True}


def _rank(values: Sequence) -> tuple:
    """Order of records: column by column, a null below all values."""
    return tuple((v is not None, v) for v in values)


class _Newest(StatefulProcessor):
    """Passes a key's record on if its order is above all that the key has shown so far."""

    def __init__(self, order: Sequence[str], state: T.StructType, ttl_ms: int | None):
        self.order, self.state, self.ttl_ms = list(order), state, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.state, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best, rank = None, _rank(tuple(self.newest.get())) if self.newest.exists() else None
        for row in rows:
            own = _rank([row[c] for c in self.order])
            if rank is None or own > rank:
                best, rank = row, own
        if best is not None:
            self.newest.update(tuple(best[c] for c in self.order))
            yield best

    def close(self) -> None:
        pass


def newest_only(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], tombstone: Column | None = None, tombstone_mode: str = "filter_first",
    ttl: timedelta | None = None,
) -> DataFrame:
    """The records of a stream of changes that are newer than all earlier ones of their key, one per key and batch.

    The state holds each key's newest order values, nothing else of the record; with `ttl` a key that has been quiet
    for so long (processing time) is forgotten, and an older record that comes later still passes again. Records are
    compared by `order`, column by column, nulls lowest; of equal ones the first stays. filter_first leaves delete
    records out; latest_wins passes them on, marked in `is_deleted`, so that an older record does not bring a key back.
    Null keys are one key.
    """
    if tombstone_mode not in ("filter_first", "latest_wins"):
        raise ValueError(f"unknown tombstone_mode {tombstone_mode!r}")
    dead = F.lit(False) if tombstone is None else F.coalesce(tombstone, F.lit(False))
    stream = stream.withColumn(DELETED_FLAG, dead) if tombstone_mode == "latest_wins" else stream.filter(~dead)
    state = T.StructType([stream.schema[c] for c in order])
    milliseconds = None if ttl is None else int(ttl.total_seconds() * 1000)
    mode = "none" if ttl is None else "processingTime"
    # Only key, order and the record go in; the key's columns are in the record too.
    named = stream.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *stream.columns)
    grouped = named.groupBy(*[f"__k{i}" for i in range(len(keys))])
    processor = _Newest(order, state, milliseconds)
    return grouped.transformWithState(processor, named.schema, "append", mode).select(*stream.columns)


def keyed_upsert(
    stream: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], checkpoint: str, *, tombstone: Column | None = None,
    tombstone_mode: str = "filter_first", ttl: timedelta | None = None, partition_by: str | None = None, once: bool = True,
) -> StreamingQuery:
    """Upsert a stream of changes into a versioned table without reading it.

    Late and older records are dropped by state (see newest_only). Each batch adds its rows in one commit that also
    holds the batch's number: a batch that is repeated after a failure is not added again. `upserted` reads the newest
    row per key, `compact` leaves only these.
    """
    spark = stream.sparkSession

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        written = None
        while True:
            after = version(session, path)
            if after is not None and after.notes.get(checkpoint, -1) >= batch_id:
                if written is None:  # the state must move on all the same
                    batch.write.format("noop").mode("overwrite").save()
                return
            written = written or add_rows(session, path, batch, partition_by)
            notes = {**(after.notes if after else {}), checkpoint: batch_id}
            try:
                commit_rows(session, path, written, batch.schema, after, partition_by, add=True, notes=notes)
                return
            except ConcurrentWrite:  # a compaction came first; the rows written hold on top of it just as well
                continue

    rows = newest_only(stream, keys, order, tombstone, tombstone_mode, ttl)
    writer = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    with _state_store(spark):
        return (writer.trigger(**_to_the_end(by_clock=ttl is not None)) if once else writer).start()


def _newest_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_per_key(rows, keys, [F.col(c).desc_nulls_last() for c in order])


def upserted(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key of a table that keyed_upsert fills; keys whose newest record is a delete are gone."""
    rows = _newest_rows(read_version(spark, path), keys, order)
    return rows.filter(~F.col(DELETED_FLAG)).drop(DELETED_FLAG) if DELETED_FLAG in rows.columns else rows


def compact(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Commit only the newest row per key, deletes included. If the stream commits meanwhile, ConcurrentWrite is raised."""
    after = version(spark, path)
    if after is None:
        return
    rows = _newest_rows(read_version(spark, path, after), keys, order)
    commit_rows(spark, path, add_rows(spark, path, rows, after.partition_by), after.schema, after, after.partition_by, notes=after.notes)


class _Silence(StatefulProcessor):
    """Follows the watermark (or the clock) over the spans of time in which a key has shown records.

    A span is a stretch of records none of which is further from the next than the smallest limit, so the spans do not
    depend on the order in which records arrive, and few are open at a time. What lies behind the watermark is final.
    """

    def __init__(self, at: str, limits: Mapping[str, timedelta], settle: timedelta, clock: str):
        micros = sorted((round(v.total_seconds() * 1_000_000), k) for k, v in limits.items())
        self.at, self.limits, self.names = at, [m for m, _ in micros], [k for _, k in micros]
        self.settle, self.clock = round(settle.total_seconds() * 1_000_000), clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Spans; levels told for the silence after the first; when the stream came back last; levels it was told at before.
        self.state = handle.getValueState("spans", "starts array<bigint>, ends array<bigint>, told int, back bigint, worst int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        spans, told, back, worst = self._load()
        near = self.limits[0]
        for row in rows:
            at = row[self.at]
            if at is None:
                continue
            # Joined with all spans within reach.
            low, high, rest = at, at, []
            for s, e in spans:
                if e + near >= at and s - near <= at:
                    low, high = min(low, s), max(high, e)
                else:
                    rest.append((s, e))
            spans = sorted([*rest, (low, high)])
        yield from self._advance(key, spans, told, back, worst, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, *self._load(), timerValues)

    def _load(self):
        if not self.state.exists():
            return [], 0, None, 0
        starts, ends, told, back, worst = tuple(self.state.get())
        return list(zip(starts, ends, strict=True)), told, back, worst

    def _advance(self, key, spans, told, back, worst, timers) -> Iterator[Row]:
        now = 1000 * (timers.getCurrentWatermarkInMs() if self.clock == "eventTime" else timers.getCurrentProcessingTimeInMs())
        due = None
        while spans:
            last = spans[0][1]
            until = spans[1][0] if len(spans) > 1 else None  # the silence ends there, as far as is known
            if told < len(self.limits) and (until is None or last + self.limits[told] < until):
                if now <= last + self.limits[told]:
                    due = last + self.limits[told]
                    break
                if told == 0 and (back is None or last - back >= self.settle):
                    worst = 0
                if told >= worst:
                    worst = told + 1
                    yield Row(**{f"__k{i}": v for i, v in enumerate(key)}, level=self.names[told], last_seen=last, crossed_at=last + self.limits[told])
                told += 1
            elif until is not None and now >= until:
                back, told, spans = (until if told else back), 0, spans[1:]
            else:
                due = until
                break
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if due is not None:
            self.handle.registerTimer(due // 1000 + 1)
        if spans:
            self.state.update(([s for s, _ in spans], [e for _, e in spans], told, back, worst))

    def close(self) -> None:
        pass


def silence_alerts(
    stream: DataFrame, keys: Sequence[str], ts: str, limits: Mapping[str, timedelta], late: str = "0 seconds", settle: timedelta = timedelta(0),
    clock: str = "eventTime",
) -> DataFrame:
    """One row (keys, level, last_seen, crossed_at) each time a key has shown no record for longer than a limit.

    An alert comes although nothing arrives: with eventTime as soon as the watermark of the whole stream, `late` behind
    its newest record, has passed the limit; with processingTime by the clock. Records may come out of order within
    `late`; the alerts are the same then. A level is told once per silence, and again after the stream came back. With
    `settle`, levels already told are not told again for a silence that begins within that time of the stream's return.

    Records without a time count for nothing; later ones than `late` are dropped. Null keys are one key. Copies of a
    record change nothing.
    """
    if not limits or clock not in ("eventTime", "processingTime"):
        raise ValueError("give limits, and eventTime or processingTime as clock")
    names = [f"__k{i}" for i in range(len(keys))]
    at = F.col(ts).cast("timestamp")
    named = stream.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], at.alias("__at"), F.unix_micros(at).alias("__us"))
    if clock == "eventTime":
        named = named.withWatermark("__at", late)
    schema = T.StructType([*[named.schema[n] for n in names], *T.StructType.fromDDL("level string, last_seen bigint, crossed_at bigint")])
    alerts = named.groupBy(*names).transformWithState(_Silence("__us", limits, settle, clock), schema, "append", clock)
    times = [F.timestamp_micros(c).alias(c) for c in ("last_seen", "crossed_at")]
    return alerts.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "level", *times)


def drain_keyed(df: DataFrame, folder: str, by_clock: bool = False) -> DataFrame:
    """Run a bounded stream with state per key to its end; its rows are read from files. by_clock: its state follows the clock."""
    with _state_store(df.sparkSession):
        query = (
            df.writeStream.format("parquet").outputMode("append").option("path", folder).option("checkpointLocation", folder + "-progress")
            .trigger(**_to_the_end(by_clock)).start()
        )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(folder)
