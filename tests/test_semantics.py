"""Behaviours that are easy to lose: null order, ties, month arithmetic, zero factors."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktally.config import DEFAULT
from stocktally.functions import scalars as S
from stocktally.operators import aggregates, cdc, joins, windows
from stocktally.plans import bi, customers, inventory
from stocktally.sources.tables import Tables


def log(spark, rows):
    schema = "id int, v string, _ab_cdc_deleted_at string, _ab_cdc_updated_at string, _airbyte_extracted_at long, _ab_cdc_log_pos long"
    return spark.createDataFrame(rows, schema)


LOG = [
    (1, "old", None, "2024-01-01 00:00:00", 0, 1), (1, "new", None, "2024-01-02 00:00:00", 0, 2),
    (2, "live", None, "2024-01-01 00:00:00", 0, 3), (2, "dead", "2024-01-03", "2024-01-03 00:00:00", 0, 4),
    (3, "late", None, "not a time", 1704499200000, 5), (3, "early", None, "2024-01-05 00:00:00", 0, 6),
    (4, "first", None, "2024-01-01 00:00:00", 0, 7), (4, "second", None, "2024-01-01 00:00:00", 0, 8),
    (None, "lost", None, "2024-01-01 00:00:00", 0, 9),
]


def test_deleted_key_falls_back_to_live_version(spark, rows):
    clean = cdc.cdc_latest(log(spark, LOG), ["id"])
    assert rows(clean, "id", "v") == [(1, "new"), (2, "live"), (3, "late"), (4, "second"), (None, "lost")]


def test_latest_wins_drops_deleted_key(spark, rows):
    clean = cdc.cdc_latest(log(spark, LOG), ["id"], tombstone_mode="latest_wins", drop_null_keys=True)
    assert rows(clean, "id", "v") == [(1, "new"), (3, "late"), (4, "second")]


def test_unknown_tombstone_mode(spark):
    with pytest.raises(ValueError):
        cdc.cdc_latest(log(spark, LOG), ["id"], tombstone_mode="other")


def test_rank_filter_limits_before_the_shuffle(spark):
    plan = cdc.cdc_latest(log(spark, LOG), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_previous_value_across_slices_nulls_and_ties(spark, rows):
    data = [("a", "2024-01-31 10:00:00", 1), ("a", "2024-01-31 10:00:00", 2), ("a", "2024-03-01 00:00:00", 3), ("a", None, 4), ("a", None, 5),
            ("b", "2024-02-01 00:00:00", 6), (None, "2024-01-01 00:00:00", 7), (None, "2024-02-01 00:00:00", 8)]
    df = spark.createDataFrame(data, "k string, t string, id int").withColumn("t", F.col("t").cast("timestamp"))
    got = windows.previous_value(df, ["k"], "t", "id", "prev", ["id"])
    assert rows(got, "id", "prev") == [(1, None), (2, 1), (3, 2), (4, 3), (5, 4), (6, None), (7, None), (8, 7)]


def test_month_boundaries(spark, rows):
    df = spark.createDataFrame([("2024-01-31", "2024-02-01"), ("2024-01-01", "2024-01-31"), ("2023-12-31", "2024-03-01")], "a string, b string")
    got = df.select(S.month_boundaries(F.col("a").cast("date"), F.col("b").cast("date")).alias("m"))
    assert sorted(r.m for r in got.collect()) == [0, 1, 3]


def test_uom_convert_zero_and_missing_factor(spark):
    df = spark.createDataFrame([(10.0, 2, 1, 12.0, 2.0), (10.0, 2, 1, 12.0, 0.0), (10.0, 1, 1, 12.0, 2.0), (10.0, 2, 1, None, None)],
                               "q double, u int, b int, m double, f double")
    guarded = [r[0] for r in df.select(S.uom_convert("q", "u", "b", "m", "f")).collect()]
    as_one = [r[0] for r in df.select(S.uom_convert("q", "u", "b", "m", "f", zero_factor_as_one=True)).collect()]
    assert guarded == [60.0, None, 10.0, 10.0]
    assert as_one == [60.0, 120.0, 10.0, 10.0]


def test_json_text_odd_keys_and_broken_text(spark):
    df = spark.createDataFrame([('{"Order Identity 1": "x", "25": {"value": "7"}}',), ("broken",), (None,)], "j string")
    got = [tuple(r) for r in df.select(S.json_text("j", "Order Identity 1"), S.json_text("j", "25", "value")).collect()]
    assert got == [("x", "7"), (None, None), (None, None)]


def test_wall_clock_is_zoneless_and_follows_dst(spark):
    df = spark.createDataFrame([("2024-01-01 04:30:00",), ("2024-07-01 03:30:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = df.select(S.wall_clock("t", "America/New_York").alias("w"))
    assert got.schema["w"].dataType.typeName() == "timestamp_ntz"
    assert [r.w for r in got.collect()] == [dt.datetime(2023, 12, 31, 23, 30), dt.datetime(2024, 6, 30, 23, 30)]


def test_zip_state(spark):
    df = spark.createDataFrame([("10001-1234",), ("90210",), ("27",), ("00601",), (None,), ("9 0-2 10",)], "z string")
    assert [r[0] for r in df.select(S.zip_state("z")).collect()] == ["NY", "CA", None, None, None, "CA"]


def test_id_list_skips_other_tokens(spark):
    df = spark.createDataFrame([("3, 1,x,,7.5,12",)], "v string")
    assert df.select(S.id_list("v")).first()[0] == [3, 1, None, None, None, 12]


def test_hour_label(spark):
    got = [r[0] for r in spark.range(24).select(S.hour_label(F.col("id"))).collect()]
    assert (got[0], got[9], got[12], got[23]) == ("12:00 AM", "9:00 AM", "12:00 PM", "11:00 PM")


def test_frequency_five_is_band_four(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,), (5,), (6,)], "n int")
    assert [r[0] for r in df.select(customers.frequency_score(F.col("n"), DEFAULT)).collect()] == [0, 1, 2, 3, 4, 5]


def test_recency_label_and_score_differ(spark):
    df = spark.createDataFrame([(150, 55.0), (200, 55.0), (366, 55.0)], "d int, m double")
    label = [r[0] for r in df.select(customers.recency_score(F.col("d"), DEFAULT.recency_label_bands)).collect()]
    score = [r[0] for r in df.select(customers.recency_score(F.col("d"), DEFAULT.recency_score_bands)).collect()]
    assert (label, score) == ([3, 2, 0], [2, 1, 0])


def segment_tables(spark):
    sales = spark.createDataFrame(
        [("Ann@X.com", 1, "2024-05-01", 100.0, 50.0, "COMPLETE"), ("bob@x.com", 2, "2024-05-31", 300.0, 200.0, "COMPLETE"),
         ("bob@x.com", 3, "2024-06-01", 900.0, 1.0, "COMPLETE"), ("bob@x.com", 4, "2024-05-01", 5.0, 1.0, "CANCELED")],
        "customer_email string, order_id int, d string, row_total double, cost double, status string").withColumn("created_at", F.col("d").cast("date"))
    return Tables(frames={
        "f_sales": sales,
        "magento_d_customerupdated": spark.createDataFrame([("ann@x.com", 1), ("bob@x.com", 2)], "customer_email string, rank_id long"),
        "magento_customer_entity": spark.createDataFrame([("bob@x.com", 1, 5), ("BOB@x.com", 2, 4), ("Ann@X.com", 1, 6)], "email string, customer_group_id int, customer_id int"),
        "customer_groups": spark.createDataFrame([(1, "General"), (2, "Wholesale")], "customer_group_id int, customer_group_code string"),
    })


def test_segmentation_as_of_first_day_and_mixed_case(spark):
    t = segment_tables(spark)
    got = {r.customer_email: r for r in customers.segmentation(t, "2024-06-01").collect()}
    bob, ann = got["bob@x.com"], got["ann@x.com"]
    # The window ends with May; the June order only counts for all time.
    assert (bob.number_of_purchases, bob.total_revenue, bob.total_purchases_all_time, bob.days_since_last_purchase) == (1, 300.0, 2, 0)
    assert (ann.number_of_purchases, ann.frequency, ann.customer_classification) == (None, "F0", "Unclassified")
    # The lowest account id has another spelling, so the group is not found.
    assert bob.customer_group == "Not Registered"
    normal = {r.customer_email: r for r in customers.segmentation(t, "2024-06-01", normalize_email=True).collect()}
    assert (normal["ann@x.com"].number_of_purchases, normal["ann@x.com"].customer_group) == (1, "General")
    assert normal["bob@x.com"].customer_group == "Wholesale"


def test_cohort_size_only_in_month_zero(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-31"), (1, "2024-02-01"), (2, "2024-01-05"), (None, "2024-01-01")], "rank_id int, d string")
    df = df.withColumn("created_at", F.col("d").cast("date"))
    got = customers.cohort_activity(df, "rank_id", "created_at", all_sizes=True)
    assert rows(got, "month_number", "purchasers", "cohort_size", "cohort_size_all") == [(0, 2, 2, 2), (1, 1, 0, 2)]


def test_whole_order_exclusion(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "bad"), (2, "a"), (None, "a")], "o int, sku string")
    assert rows(joins.without_groups(df, "o", F.col("sku") == "bad")) == [(2, "a"), (None, "a")]


def test_inherit_keeps_own_values_without_parent(spark, rows):
    df = spark.createDataFrame([(1, None, "configurable", 9.0), (2, 1, "simple", 0.0), (3, 99, "simple", 4.0), (4, None, "simple", 5.0)],
                               "id int, parent int, kind string, v double")
    got = joins.inherit_from_parent(df, "id", "parent", F.col("kind") == "configurable", ["v"])
    assert rows(got, "id", "v") == [(1, 9.0), (2, 9.0), (3, 4.0), (4, 5.0)]


def test_ordered_text_keeps_repeats_and_skips_null(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string")
    assert rows(aggregates.ordered_text(df, ["k"], "v", "-", "t")) == [(1, "a-b-b")]


def test_stock_counts_serials(spark, rows):
    t = Tables(frames={
        "fishbowl_location": spark.createDataFrame([(1, 8)], "location_id int, location_group_id int"),
        "fishbowl_tag": spark.createDataFrame([(10, 1, 5, 100, 3.0), (11, 1, None, 101, 1.0)], "tag_id int, location_id int, part_id int, tag_number int, quantity_on_tag double"),
        "fishbowl_tagserialview": spark.createDataFrame([(10, "s1"), (10, "s1"), (10, "s2")], "tag_id int, serial_number_value string"),
    })
    assert rows(inventory.serial_on_hand(t), "serial_number", "calculated_quantity_on_hand") == [("s1", -1.0), ("s2", 1.0)]


@pytest.mark.parametrize("kind, expected", [
    ("TODAY", ("2024-03-31", "2024-03-31", "2024-03-30", "2024-03-30")), ("MTD", ("2024-03-01", "2024-03-31", "2024-02-01", "2024-02-29")),
    ("YTD", ("2024-01-01", "2024-03-31", "2023-01-01", "2023-03-31"))])
def test_periods(kind, expected):
    p = bi.period(kind, "2024-03-31")
    assert tuple(str(d) for d in (p.start, p.end, p.compare_start, p.compare_end)) == expected


def test_custom_period_is_cut_at_today():
    p = bi.period("CUSTOM", "2024-02-10", 2024, 2)
    assert (str(p.end), str(p.compare_start), str(p.compare_end)) == ("2024-02-10", "2023-02-01", "2023-02-10")


def test_config_is_frozen():
    with pytest.raises(dataclasses.FrozenInstanceError):
        DEFAULT.base_uom_id = 2


def test_groups_keep_rows_with_null_keys(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0), (None, 6.0)], "k string, v double")
    assert rows(windows.count_of_group(df, ["k"], "n"), "v", "n") == [(1.0, 2), (2.0, 2), (3.0, 2), (6.0, 2)]
    assert rows(windows.share_of_group(df, ["k"], "v", "s"), "v", "s") == [(1.0, 0.25), (2.0, 0.25), (3.0, 0.75), (6.0, 0.75)]


def test_slices_are_bounded_on_one_key_and_one_day(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.lit("2024-01-01").cast("date").alias("t"), F.col("id"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = windows.previous_value(df, ["k"], "t", "v", "prev", ["id"])
        tasks = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(tasks) >= 4 and max(tasks) <= 2000
    assert got.filter("(v = 0 and prev is not null) or (v > 0 and prev <> v - 1)").isEmpty()


def test_first_abnormal_event_of_arrays_and_of_a_log(spark):
    from stocktally.plans import usage

    log = [("a", "x", 5, 1), ("a", "late", 9, 1), ("a", "y", 5, 2), ("b", "no time", None, 1), ("b", "x", 3, 3), (None, "z", 1, 1), ("c", "only", None, 1)]
    rows = spark.createDataFrame(log, "k string, reason string, first_ts int, count int")
    flat = usage.first_abnormal_of_log(rows, ["k"], "reason", "first_ts", F.col("count"), F.lit(4))
    arrays = rows.groupBy("k").agg(F.collect_list(F.struct("reason", "first_ts", "count")).alias("events"), F.lit(4).alias("started"))
    nested = usage.first_abnormal_event(arrays, "k", "events", "started")
    columns = ["k", "first_reason", "first_event_ts", "event_count", "confidence"]
    got = sorted(map(tuple, flat.select(*columns).collect()), key=str)
    assert got == sorted(map(tuple, nested.select(*columns).collect()), key=str)
    assert got == sorted([("a", "x", 5, 1, "inferred"), ("b", "x", 3, 3, "inferred"), (None, "z", 1, 1, "authoritative"), ("c", "only", None, 1, "authoritative")], key=str)
