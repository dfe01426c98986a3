"""Landing tables through to sales, by hand-computed numbers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocktally.config import DEFAULT
from stocktally.plans import build, forecast, sales
from stocktally.session import shared_folder

FIRST, LATER = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def landing(spark, schema, live, versions=()):
    """Rows as a change log: optional older or deleted versions come as (row, deleted, updated)."""
    full = schema + ", _ab_cdc_deleted_at string, _ab_cdc_updated_at string, _airbyte_extracted_at long"
    rows = [(*r, None, LATER, 0) for r in live] + [(*r, d, u, 0) for r, d, u in versions]
    return spark.createDataFrame(rows, full)


def ts(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def model(spark):
    item = ("item_id long, order_id long, product_id long, parent_item_id long, sku string, product_type string, weight double, qty_ordered double, "
            "row_total double, amount_refunded double, discount_amount double, discount_refunded double, tax_amount double, base_cost double, store_id int, "
            "vendor long, product_options string, created_at timestamp")

    def line(i, order, product, sku, kind, weight, qty, total, parent=None, cost=1.0, refunded=None, day="2024-05-10 02:00:00"):
        return (i, order, product, parent, sku, kind, weight, qty, total, refunded, None, None, 0.0, cost, 1, 7, None, ts(day))

    items = landing(spark, item, [
        line(11, 1, 100, "A", "configurable", 2.0, 2.0, 40.0),
        line(12, 1, 101, "A-1", "simple", 0.0, 2.0, 0.0, parent=11),
        line(13, 1, 102, "B", "simple", 6.0, 1.0, 60.0),
        line(21, 2, 102, "B", "simple", 6.0, 1.0, 10.0, day="2024-05-11 12:00:00"),
        line(22, 2, 102, "00-CSG", "simple", 6.0, 1.0, 10.0),
        line(31, 3, 103, "C", None, 1.0, 1.0, 5.0),
        line(51, 5, 102, "B", "simple", 6.0, 1.0, 8.0),
        line(41, 4, 102, "B", "simple", 6.0, 3.0, 33.0, cost=9.0, day="2024-05-12 12:00:00"),
    ], [(line(13, 1, 102, "B", "simple", 6.0, 1.0, 999.0), None, FIRST),
        (line(99, 1, 102, "B", "simple", 6.0, 1.0, 7.0), "2024-02-01", LATER)])
    order = ("entity_id long, increment_id string, status string, customer_email string, customer_id long, customer_firstname string, customer_lastname string, "
             "billing_address_id long, shipping_amount double, base_shipping_amount double, base_shipping_canceled double, base_shipping_discount_amount double, "
             "base_shipping_refunded double, base_shipping_tax_amount double, base_shipping_tax_refunded double")
    orders = landing(spark, order, [
        (k, str(1000 + k), "complete", mail, k, "F", "L", k, 8.0, 8.0, None, 0.0, None, 0.0, None)
        for k, mail in ((1, "Ann@x.com"), (2, ""), (3, "bob@x.com"), (4, "bob@x.com"))])
    erp_item = ("id long, soid long, productid long, productnum string, description string, qtyordered double, qtyfulfilled double, qtytofulfill double, "
                "totalprice double, totalcost double, typeid int, statusid int, uomid int, customfields string")

    def erp(i, so, product, price, cost, link, qty=1.0):
        fields = None if link is None else f'{{"25": {{"value": "{link}"}}}}'
        return (i, so, product, f"P{product}", "thing", qty, 0.0, qty, price, cost, 10, 10, 1, fields)

    frames = {
        "magento.sales_order_item": items, "magento.sales_order": orders,
        "magento.sales_order_address": landing(spark, "entity_id long, parent_id long, address_type string, postcode string, country_id string, region string, city string, street string, telephone string",
                                               [(1, 1, "billing", "10001", "US", "NY", "New York", "s", "t")]),
        "magento.catalog_product_entity": landing(spark, "entity_id long, attribute_set_id int, type_id string, sku string, has_options int, required_options int",
                                                  [(100, 1, "c", "A", 0, 0), (101, 1, "s", "A-1", 0, 0), (102, 50, "s", "B", 1, 0), (103, 1, "s", "C", 0, 0)]),
        "fishbowl.so": landing(spark, "id long, num string, statusid int, email string, phone string, billtoname string, billtoaddress string, billtocity string, billtozip string, locationgroupid int, customfields string, datecreated timestamp", [
            (501, "1001-1", 60, None, None, None, None, None, None, 8, None, ts("2024-05-10 02:00:00")),
            (502, "GB77", 25, "gb@x.com", "t", "n", "a", "c", "90210", 8, None, ts("2024-05-10 02:00:00"))]),
        "fishbowl.soitem": landing(spark, erp_item, [
            erp(1, 501, 1, 40.0, 12.0, 11), erp(2, 501, 2, 30.0, 20.0, 13), erp(3, 501, 2, 30.0, 40.0, 13),
            erp(4, 502, 1, 30.0, 9.0, None, 2.0), erp(5, 502, 2, 10.0, 3.0, None)]),
        "fishbowl.plugininfo": landing(spark, "id long, recordid long, groupid int, channelid string, plugin string, info string, tablename string",
                                       [(1, 1, 0, "100", "p", "i", "Product"), (2, 2, 0, "102", "p", "i", "Product")]),
        "fishbowl.objecttoobject": landing(spark, "id long, typeid int, tableid1 int, recordid1 long, tableid2 int, recordid2 long, note string", [(1, 30, 0, 998, 0, 999, None)]),
        "fishbowl.product": landing(spark, "id long, num string, partid long, uomid int, kitflag int", [(1, "A", 1, 1, 0), (2, "B", 2, 2, 0)]),
        "fishbowl.part": landing(spark, "id long, num string, uomid int", [(1, "A", 1), (2, "B", 1)]),
        "fishbowl.partcost": landing(spark, "id long, partid long, avgcost double", [(1, 1, 5.0), (2, 2, 1.0)]),
        "fishbowl.uomconversion": landing(spark, "id long, fromuomid int, touomid int, multiply double, factor double, description string", [(1, 2, 1, 20.0, 1.0, "box")]),
        "fishbowl.ship": landing(spark, "id long, soid long, carrierserviceid int", [(71, 501, 4), (72, 502, 4)]),
        "fishbowl.shipcarton": landing(spark, "id long, shipid long, trackingnum string, freightamount double, freightweight double", [(81, 71, "T1", 99.0, 3.0), (82, 72, "T2", 6.0, 3.0)]),
        "ups.ups_invoice": spark.createDataFrame([("T1", 3.0), ("T1", 1.0)], "tracking_number string, net_amount double"),
    }
    return build.model(frames, {}).stored(build.SHARED)


def test_sales_rows(model):
    got = {r["id"]: r for r in model["f_sales"].collect()}
    # The configurable parent, the excluded order 2 and the row without type are gone.
    assert set(got) == {12, 13, 41, 51, -4, -5}
    child, plain, late = got[12], got[13], got[41]
    # The child carries its parent's revenue, quantity, cost and freight.
    assert (child["row_total"], child["qty_ordered"], child["cost"], child["testr"]) == (40.0, 2.0, 12.0, 40.0)
    # Two ERP lines for one item and product: their mean.
    assert (plain["row_total"], plain["cost"]) == (60.0, 30.0)
    # Freight by weight 2 : 6 of 8.0 charged and 4.0 invoiced.
    assert (child["freight_revenue"], plain["freight_revenue"]) == (2.0, 6.0)
    assert (child["freight_cost"], plain["freight_cost"]) == (1.0, 3.0)
    # No ERP line: unit cost of the newest costed row of the product.
    assert late["cost"] == pytest.approx(90.0)
    assert plain["part_qty_sold"] == 20.0
    # 02:00 UTC is the evening before in the shop's zone.
    assert plain["created_at"] == dt.date(2024, 5, 9) and plain["hour_text"] == "22:00:00"
    assert plain["region"] == "NY" and late["region"] is None
    # An item without its order belongs to the unknown customer.
    assert got[51]["rank_id"] == 3 and got[51]["increment_id"] is None


def test_marketplace_rows(model):
    got = {r["id"]: r for r in model["int_fishbowl_gunbroker_sales"].collect()}
    first, second = got[-4], got[-5]
    assert (first["status"], first["storefront"], first["order_id"], first["product_id"]) == ("PROCESSING", "GunBroker", -502, 100)
    assert (first["freight_cost"], second["freight_cost"]) == (4.5, 1.5)
    assert (first["part_qty_sold"], second["part_qty_sold"], second["conversion"]) == (2.0, 20.0, 20.0)


def test_customer_ids_are_dense_and_ordered(model):
    ids = {r.customer_email: r.rank_id for r in model["magento_d_customerupdated"].collect()}
    assert ids == {"ann@x.com": 1, "bob@x.com": 2, DEFAULT.default_customer_email: 3}


def test_increment_reads_whole_orders(model):
    day = sales.sales_increment(model, "2024-05-12")
    assert {r.id for r in day.collect()} == {12, 13, 41, 51, -4, -5}
    assert {r.id for r in sales.sales_increment(model, "2024-05-15").collect()} == {41}


def test_products_and_enrichment_need_no_other_tables(model):
    pieces = {r.item_id: r.part_qty_sold for r in model["int_magento_product_conversion"].collect()}
    assert pieces == {11: 2.0, 13: 20.0, 21: 20.0, 22: 20.0, 41: 60.0}


def test_materialize_reads_back(spark, model):
    import uuid

    build.materialize(model, f"{shared_folder(spark)}/gold-{uuid.uuid4().hex}", ["int_item_costs", "f_sales"])
    assert "Scan parquet" in model["f_sales"]._jdf.queryExecution().toString() or "parquet" in model["f_sales"]._jdf.queryExecution().toString()
    assert model["f_sales"].count() == 6


def test_forecast_recovers_trend_and_weekday(spark):
    days = spark.range(140).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"), F.col("id").alias("i"))
    series = days.withColumn("y", F.col("i") * 2.0 + F.when(F.weekday("d") == 5, 50.0).otherwise(0.0)).withColumn("s", F.lit("a"))
    train, test = series.filter("i < 112"), series.filter("i >= 112")
    ahead = forecast.forecast(train, ["s"], "d", "y", 28).join(test, F.col("forecast_date") == F.col("d"))
    assert ahead.count() == 28
    assert ahead.filter(F.abs(F.col("y") - F.col("predicted_units")) > 2).count() == 0
    assert forecast.backtest(series, ["s"], "d", "y", "2024-04-21", 28).first().mape < 1
    spiky = test.withColumn("y", F.when(F.col("i") == 120, 1e6).otherwise(F.col("y")))
    flagged = forecast.detect_anomalies(train, spiky, ["s"], "d", "y").filter("is_anomaly")
    assert [r.anomaly_date for r in flagged.collect()] == [dt.date(2024, 4, 30)]


def test_single_day_series_has_no_trend(spark):
    one = spark.createDataFrame([("a", "2024-01-01", 5.0)], "s string, d string, y double").withColumn("d", F.col("d").cast("date"))
    got = forecast.forecast(one, ["s"], "d", "y", 2).collect()
    assert [(r.predicted_units, r.lower_bound) for r in got] == [(5.0, 5.0), (5.0, 5.0)]


def test_projection_of_the_whole_stock(spark):
    stock = spark.createDataFrame([(10.0,)], "qty double")
    coming = spark.createDataFrame([("2024-01-03", 5.0)], "d string, qty double").select(F.col("d").cast("date").alias("day"), "qty")
    rate = spark.createDataFrame([(4.0,)], "rate double")
    got = forecast.project_inventory(stock, coming, rate, [], "2024-01-01", "2024-01-05").orderBy("day").collect()
    assert [r.projected_qty for r in got] == [6.0, 2.0, 3.0, 0.0, 0.0]
    assert {r.stockout_date for r in got} == {dt.date(2024, 1, 4)}


def test_stream_keeps_the_newer_record(spark, rows):
    import uuid

    from stocktally.sources.sinks import read_table
    from stocktally.streaming.live import cdc_stream_upsert

    newest = lambda: [F.col("t").desc()]
    for by in ({}, {"partition_by": "p", "fixed_partition": True}):
        root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
        for batch in ([(1, 10, "new"), (2, 1, "a")], [(1, 5, "older"), (2, 2, "b")]):
            spark.createDataFrame(batch, "k int, t int, v string").write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema("k int, t int, v string").parquet(f"{root}/in").withColumn("p", F.col("k") % 2)
            cdc_stream_upsert(stream, f"{root}/out", ["k"], f"{root}/check", newest_first=newest, **by).awaitTermination()
        assert rows(read_table(spark, f"{root}/out"), "k", "v") == [(1, "new"), (2, "b")]
