"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition above this bit

# Runtime settings every job relies on. They can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key must be split even when the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A batch of texts lies in the executor and in its Python worker at once; 10,000 rows, the default, can be tens of MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

# Before a join is planned only file sizes are known, and a few MB of compressed columns can be some hundred MB of rows in
# the driver that builds a broadcast. The planner therefore broadcasts tiny files only; larger sides wait for their shuffle,
# whose size in rows is measured.
# A joining task sorts both its sides and often a third, and 64 MB of a shuffle, the default, can be a GB of sorted rows: at
# size each join would spill more than it moves. A scan that sorts, as the change log's does, has the same need.
MODEL_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "32KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.files.maxPartitionBytes": "8MB",
}
_WIDEST = 4 << 20  # bytes of input files for each partition of a shuffle: the widest one has four times the input's bytes


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def tune_model(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """The runtime settings, and those of the many joins of the table model.

    Shuffles begin with more partitions than the cluster's width where the input's files are large; small ones are joined
    when their sizes are known.
    """
    for key, value in MODEL_CONF.items():
        spark.conf.set(key, value)
    width = -(-input_bytes // _WIDEST)
    if width > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
    return tune(spark)


def build_session(app: str = "stocktally", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; the cluster decides memory, cores and shuffle width."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the one named by spark.checkpoint.dir.

    Only a session of one process (local, local[n]) without that setting falls back to a temporary folder.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="stocktally-")
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame, name: str = "cut", compression: str | None = None) -> DataFrame:
    """Write a result to the shared folder once and read it back.

    Later readers scan columns of the files instead of repeating the work, also after
    an executor is lost, and the planner sees real sizes when it picks joins. The session's
    compression, unless another is named: zstd takes less of the folder, and more time to write.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
