"""Stored tables with atomic commits: immutable folders of rows, and one numbered commit file per version.

A version lists the folders that make up the table. Rows are written to a new folder first; then the version's commit
file is renamed into place, which fails if that number is taken. Readers follow the highest commit file, so they see the
table before a write or after it, never between. Old versions stay readable until `retain` removes them.

The file system must rename without replacing (HDFS, a local disk, object stores with such a rename).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

COMMITS, ROWS, PART = "_commits", "_rows", "__part"


class ConcurrentWrite(RuntimeError):
    """Another writer has committed since this one read the table."""


@dataclass(frozen=True)
class Version:
    """What a commit file says."""

    number: int
    schema: T.StructType
    partition_by: str | None = None
    parts: dict[str, tuple[str, ...]] = field(default_factory=dict)  # folders, relative to the table, by partition
    notes: dict[str, int] = field(default_factory=dict)  # what a writer wants to find again, such as its last batch


def part_of(column: str) -> Column:
    """Name of the partition of a row: safe in a path, the same for equal values, also for nulls."""
    return F.coalesce(F.concat(F.lit("v"), F.hex(F.col(column).cast("string"))), F.lit("null"))


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    fs, folder = _files(spark, f"{path}/{COMMITS}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version of the table, by default the current one; None if nothing has been committed."""
    if number is None:
        known = versions(spark, path)
        if not known:
            return None
        number = known[-1]
    fs, _ = _files(spark, path)
    stream = fs.open(_path(spark, path, COMMITS, f"{number:012d}.json"))
    try:
        said = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, T.StructType.fromJson(said["schema"]), said["partition_by"], {k: tuple(v) for k, v in said["parts"].items()}, said["notes"])


def read_version(spark: SparkSession, path: str, at: Version | None = None, parts: Sequence[str] | None = None) -> DataFrame:
    """Rows of a version (the current one by default), or of some of its partitions. Other folders are not listed."""
    at = at or version(spark, path)
    if at is None:
        raise FileNotFoundError(f"no version of a table in {path}")
    wanted = at.parts if parts is None else {p: at.parts[p] for p in parts if p in at.parts}
    folders = [f"{path}/{f}" for folders in wanted.values() for f in folders]
    if not folders:
        return spark.createDataFrame([], at.schema)
    return spark.read.schema(at.schema).parquet(*folders)


def add_rows(spark: SparkSession, path: str, df: DataFrame, partition_by: str | None = None) -> dict[str, tuple[str, ...]]:
    """Write rows to a new folder that no version knows yet; its folders by partition."""
    into = f"{ROWS}/{uuid.uuid4().hex}"
    if partition_by is None:
        df.write.parquet(f"{path}/{into}")
        return {"": (into,)}
    df.withColumn(PART, part_of(partition_by)).write.partitionBy(PART).parquet(f"{path}/{into}")
    fs, folder = _files(spark, f"{path}/{into}")
    names = [f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory()]
    return {n.partition("=")[2]: (f"{into}/{n}",) for n in names if n.startswith(PART + "=")}


def publish(spark: SparkSession, path: str, after: Version | None, new: Version) -> Version:
    """Make a version current, if the one it was made from still is.

    The commit file is complete before its name appears; of two writers with one number the second fails.
    """
    fs, _ = _files(spark, path)
    draft = _path(spark, path, COMMITS, f".draft-{uuid.uuid4().hex}")
    said = {"schema": new.schema.jsonValue(), "partition_by": new.partition_by, "parts": new.parts, "notes": new.notes}
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(said).encode()))
    finally:
        out.close()
    newest = versions(spark, path)
    if newest and newest[-1] != (after.number if after else 0):
        fs.delete(draft, False)
        raise ConcurrentWrite(f"{path} is at version {newest[-1]}, this write began at {after.number if after else 0}")
    target = _path(spark, path, COMMITS, f"{new.number:012d}.json")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
    except Exception as error:
        if fs.exists(target):
            fs.delete(draft, False)
            raise ConcurrentWrite(f"version {new.number} of {path} was committed by another writer") from error
        raise
    return new


def commit(
    spark: SparkSession, path: str, df: DataFrame, after: Version | None, partition_by: str | None = None, keep: Callable[[str], bool] | None = None,
    add: bool = False,
) -> Version:
    """Write rows and make the table of them, after the version they were made from.

    With `keep` the partitions of `after` that it accepts stay, by reference; with `add` all rows of `after` stay. Columns
    that only one side has are null on the other.
    """
    return commit_rows(spark, path, add_rows(spark, path, df, partition_by), df.schema, after, partition_by, keep, add)


def commit_rows(
    spark: SparkSession, path: str, written: dict[str, tuple[str, ...]], schema: T.StructType, after: Version | None, partition_by: str | None = None,
    keep: Callable[[str], bool] | None = None, add: bool = False, notes: dict[str, int] | None = None,
) -> Version:
    """The second half of commit(): publish folders that add_rows has written. Notes stay if none are given."""
    parts = {p: f for p, f in after.parts.items() if add or (keep is not None and keep(p))} if after else {}
    for p, folders in written.items():
        parts[p] = parts.get(p, ()) + folders
    known = {f.name for f in schema.fields}
    older = [f for f in after.schema.fields if f.name not in known] if after and (add or keep) else []
    whole = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*schema.fields, *older]])
    notes = (after.notes if after else {}) if notes is None else notes
    return publish(spark, path, after, Version((after.number if after else 0) + 1, whole, partition_by, parts, notes))


def retain(spark: SparkSession, path: str, last: int = 3, idle_hours: float = 24.0) -> list[str]:
    """Remove all but the newest versions, and row folders that none of these holds; gives the removed names.

    Row folders younger than idle_hours stay, because a running write may be about to commit them.
    """
    numbers = versions(spark, path)
    kept = [version(spark, path, n) for n in numbers[-max(last, 1):]]
    used = {f.split("/")[1] for v in kept for folders in v.parts.values() for f in folders}
    fs, _ = _files(spark, path)
    gone = []
    for n in numbers[: -max(last, 1)]:
        fs.delete(_path(spark, path, COMMITS, f"{n:012d}.json"), False)
        gone.append(f"{COMMITS}/{n:012d}.json")
    rows = _path(spark, path, ROWS)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for status in fs.listStatus(rows) if fs.exists(rows) else []:
        name = status.getPath().getName()
        if name not in used and now - status.getModificationTime() >= idle_hours * 3_600_000:
            fs.delete(status.getPath(), True)
            gone.append(f"{ROWS}/{name}")
    return gone
