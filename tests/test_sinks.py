"""Merge, archive, history and reading back."""

import uuid

from pyspark.sql import functions as F

from stocktally.operators import history
from stocktally.session import shared_folder
from stocktally.sources import readers, sinks


def folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, day string")


def test_merge_creates_then_updates(spark, rows):
    path = folder(spark, "merge")
    sinks.merge_by_key(spark, path, frame(spark, [(1, "a", "d1"), (2, "b", "d2")]), ["id"])
    sinks.merge_by_key(spark, path, frame(spark, [(2, "B", "d2"), (3, "c", "d3")]), ["id"])
    assert rows(sinks.read_table(spark, path), "id", "v") == [(1, "a"), (2, "B"), (3, "c")]


def test_merge_moves_a_row_between_partitions(spark, rows):
    path = folder(spark, "merge")
    sinks.merge_by_key(spark, path, frame(spark, [(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d3")]), ["id"], "day")
    sinks.merge_by_key(spark, path, frame(spark, [(2, "moved", "d1"), (4, "x", None)]), ["id"], "day")
    assert rows(sinks.read_table(spark, path), "id", "v", "day") == [(1, "a", "d1"), (2, "moved", "d1"), (3, "c", "d3"), (4, "x", None)]


def test_merge_is_repeatable(spark, rows):
    path = folder(spark, "merge")
    batch = frame(spark, [(1, "a", "d1")])
    for _ in range(3):
        sinks.merge_by_key(spark, path, batch, ["id"], "day")
    assert rows(sinks.read_table(spark, path), "id", "v", "day") == [(1, "a", "d1")]


def test_scd2_check(spark, rows):
    cur = "k int, a string, b string"
    first = history.scd2_check(spark.createDataFrame([(1, "x", "p"), (2, "y", "q"), (3, "z", None)], cur), None, "k", ["a", "b"], "2024-01-01")
    second = history.scd2_check(spark.createDataFrame([(1, "x", "p"), (2, "Y", "q"), (4, "n", "r"), (3, "z", None)], cur), first, "k", ["a", "b"], "2024-02-01")
    third = history.scd2_check(spark.createDataFrame([(2, "Y", "q"), (4, "n", "s"), (3, "z", None)], cur), second, "k", ["a", "b"], "2024-03-01")
    got = rows(third.select("k", "a", "b", F.date_format("valid_from", "MM").alias("f"), F.date_format("valid_to", "MM").alias("t")))
    assert got == [(1, "x", "p", "01", "03"), (2, "Y", "q", "02", None), (2, "y", "q", "01", "02"), (3, "z", None, "01", None),
                   (4, "n", "r", "02", "03"), (4, "n", "s", "03", None)]
    assert rows(history.as_of(third, "2024-02-15"), "k", "b") == [(1, "p"), (2, "q"), (3, None), (4, "r")]


def test_csv_readers(spark, rows, tmp_path):
    (tmp_path / "inv.csv").write_text("tracking_number,net_amount\nT1,1.5\nT1,2.25\n")
    (tmp_path / "groups.csv").write_text("customer_group_id,customer_group_code\n0,NOT LOGGED IN\n1,General\n")
    assert [float(r[0]) for r in readers.read_invoices(spark, str(tmp_path / "inv.csv")).groupBy().sum("net_amount").collect()] == [3.75]
    assert rows(readers.read_seed(spark, str(tmp_path / "groups.csv"))) == [(0, "NOT LOGGED IN"), (1, "General")]


def test_catalog_and_glob_readers(spark, rows):
    root = folder(spark, "landing")
    frame(spark, [(1, "a", "d")]).write.parquet(f"{root}/fishbowl/so")
    frame(spark, [(2, "b", "d")]).write.parquet(f"{root}/logs/2024_01_01/part")
    frame(spark, [(3, "c", "d")]).write.parquet(f"{root}/logs/2024_01_02/part")
    assert rows(readers.read_source(spark, "fishbowl.so", root), "id") == [(1,)]
    assert rows(readers.read_cdc_files(spark, f"{root}/logs/*/part"), "id") == [(2,), (3,)]
    frame(spark, [(9, "v", "d")]).createOrReplaceTempView("view_table")
    assert sinks.merge_sql("cat.t", "view_table", ["id"]).startswith("MERGE INTO cat.t t USING view_table s ON t.id = s.id")


def test_archive_keeps_other_types(spark, rows):
    root = folder(spark, "archive")
    def rows_of(kind, v):
        return spark.createDataFrame([(v,)], "v int").withColumn("kind", F.lit(kind))
    for kind, v in (("a", 1), ("b", 2), ("a", 3)):
        sinks.archive_then_overwrite(spark, f"{root}/now", f"{root}/old", rows_of(kind, v), "kind", kind, "2024-01-01")
    assert rows(sinks.read_table(spark, f"{root}/now"), "kind", "v") == [("a", 3), ("b", 2)]
    assert rows(sinks.read_table(spark, f"{root}/old"), "kind", "v") == [("a", 1)]


def test_merge_keeps_text_partitions_apart(spark, rows):
    path = folder(spark, "merge")
    data = [(1, "a", "01"), (2, "b", "10"), (3, "c", "x:1"), (4, "d", "2024-01-01 10:00:00"), (5, "e", None)]
    first = frame(spark, data)
    sinks.merge_by_key(spark, path, first, ["id"], "day")
    for _ in range(2):
        sinks.merge_by_key(spark, path, frame(spark, [(1, "A", "01"), (3, "C", "y/2"), (4, "D", "01"), (5, "E", "x:1")]), ["id"], "day")
    got = rows(sinks.read_merged(spark, path, first, "day"), "id", "v", "day")
    assert got == [(1, "A", "01"), (2, "b", "10"), (3, "C", "y/2"), (4, "D", "01"), (5, "E", "x:1")]


def test_merge_matches_null_keys_and_refuses_repeated_ones(spark, rows):
    import pytest

    for by in (None, "day"):
        path = folder(spark, "merge")
        batch = frame(spark, [(None, "n", "d1"), (1, "a", "d1")])
        for _ in range(3):
            sinks.merge_by_key(spark, path, batch, ["id"], by)
        assert rows(sinks.read_table(spark, path), "id", "v") == [(1, "a"), (None, "n")]
        with pytest.raises(ValueError, match="more than once"):
            sinks.merge_by_key(spark, path, frame(spark, [(1, "x", "d1"), (1, "y", "d2")]), ["id"], by)
        assert rows(sinks.read_table(spark, path), "id", "v") == [(1, "a"), (None, "n")]


def test_merge_leaves_a_folder_it_cannot_read_alone(spark, rows):
    import pytest
    from pyspark.errors import AnalysisException

    root = folder(spark, "laid")
    frame(spark, [(1, "a", "d")]).write.parquet(f"{root}/2024/01")
    with pytest.raises(AnalysisException):
        sinks.merge_by_key(spark, root, frame(spark, [(2, "b", "d")]), ["id"])
    assert rows(spark.read.parquet(f"{root}/2024/01"), "id") == [(1,)]


def test_archive_twice_with_one_stamp(spark, rows):
    root = folder(spark, "archive")
    rows_of = lambda v: spark.createDataFrame([(v,)], "v int").withColumn("kind", F.lit("a"))
    for v, at in ((1, "2024-01-01"), (2, "2024-02-01"), (3, "2024-02-01")):
        sinks.archive_then_overwrite(spark, f"{root}/now", f"{root}/old", rows_of(v), "kind", "a", at)
    assert rows(sinks.read_table(spark, f"{root}/old"), "v") == [(1,)] and rows(sinks.read_table(spark, f"{root}/now"), "v") == [(3,)]


def test_sources_by_address(spark):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="file:/nowhere/landing/fishbowl/so"):
        readers.read_source(spark, "fishbowl.so", "file:///nowhere/landing/")


def test_stream_deletes_in_both_modes(spark, rows):
    from stocktally.streaming import live

    schema = "id int, v string, at int, gone boolean"
    source = folder(spark, "changes")
    batches = ([(1, "a", 1, False), (2, "b", 1, False)], [(1, None, 3, True)], [(1, "late", 2, False), (2, "B", 2, False)])
    for mode, want in (("latest_wins", [(2, "B")]), ("filter_first", [(1, "late"), (2, "B")])):
        path = folder(spark, "kept")
        for i, batch in enumerate(batches):
            if mode == "latest_wins":
                spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
            else:
                spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source + "2")
            live.cdc_stream_upsert(
                spark.readStream.schema(schema).parquet(source if mode == "latest_wins" else source + "2"), path, ["id"], path + "-progress",
                newest_first=lambda: [F.desc("at")], tombstone=lambda: F.col("gone"), tombstone_mode=mode,
            ).awaitTermination()
        kept = sinks.read_table(spark, path)
        assert rows(live.live_rows(kept) if mode == "latest_wins" else kept, "id", "v") == want
