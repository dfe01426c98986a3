"""Tables by partition: files that are not small."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktally.sources import versions
from stocktally.sources.sinks import merge_by_key, write_table


def test_partitioned_writes_make_few_files(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 8).select("id", (F.col("id") % 20).cast("string").alias("month")).withColumn("month", F.when(F.col("id") != 7, F.col("month")))
    merge_by_key(spark, f"{tmp_path}/v", rows, ["id"], "month")
    write_table(rows, f"{tmp_path}/p", partition_by=["month"])
    for name in ("v/_rows", "p"):
        files = list((tmp_path / name).rglob("*.parquet"))
        assert 21 <= len(files) <= 24, len(files)  # 161 before
    assert versions.read_version(spark, f"{tmp_path}/v").exceptAll(rows).isEmpty() and spark.read.parquet(f"{tmp_path}/p").count() == 4000
    merge_by_key(spark, f"{tmp_path}/v", rows.withColumn("month", F.lit("1")).filter("id % 2 = 1"), ["id"], "month")
    written = {f for folders in versions.version(spark, f"{tmp_path}/v").parts.values() for f in folders}
    assert all(len(list((tmp_path / "v" / f).glob("*.parquet"))) <= 2 for f in written)
    assert versions.read_version(spark, f"{tmp_path}/v").groupBy("month").count().filter("month = '1'").first()["count"] == 2000
