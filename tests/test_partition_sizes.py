"""Tasks of the table model get partitions that they can sort without spilling."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stocktally.session import MODEL_CONF, RUNTIME_CONF, tune_model

_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


@pytest.fixture
def settings(spark):
    """The session's settings come back after the test."""
    before = {n: spark.conf.get(n, None) for n in (*MODEL_CONF, *RUNTIME_CONF, _WIDTH, _FIRST)}
    yield spark.conf
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _partitions(df) -> int:
    return len(df.groupBy(F.spark_partition_id()).agg(F.max("v")).collect())


def test_partitions_are_joined_to_sixteen_mb_only(spark, settings):
    tune_model(spark, 400 << 20)
    settings.set(_FIRST, "false")
    moved = spark.range(3_000_000).select("id", F.rand(1).alias("v")).repartition("id")
    assert 2 <= _partitions(moved) <= 8  # about 40 MB


def test_shuffles_of_a_large_input_begin_with_more_partitions(spark, settings):
    tune_model(spark, 400 << 20)
    assert settings.get(_WIDTH) == "100"


def test_shuffles_of_a_small_input_keep_the_width_of_the_cluster(spark, settings):
    settings.unset(_WIDTH)
    tune_model(spark, 20 << 20)
    assert settings.get(_WIDTH, None) is None


def test_scans_read_eight_mb_at_most(spark, settings, tmp_path):
    spark.range(30_000_000).select(F.rand(2).alias("v")).repartition(8).write.parquet(str(tmp_path / "v"))
    tune_model(spark)
    assert spark.read.parquet(str(tmp_path / "v")).rdd.getNumPartitions() >= 24  # about 240 MB
