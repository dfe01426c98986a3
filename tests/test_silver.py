"""Names, flags and keys of the cleaned tables."""

import pytest
from pyspark.sql import functions as F

from stocktally.sources import silver
from stocktally.sources.naming import split_words

# Landing columns that the models depend on, with the name they must get.
NEEDED = {
    "fishbowl_so": {"id": "sales_order_id", "num": "sales_order_number", "statusid": "status_id", "email": "customer_email", "phone": "customer_phone",
                    "billtoname": "bill_to_name", "billtozip": "bill_to_zip", "datecreated": "created_at", "locationgroupid": "location_group_id", "customfields": "custom_fields"},
    "fishbowl_soitem": {"id": "so_item_id", "soid": "sales_order_id", "productid": "product_id", "productnum": "product_number", "description": "product_description",
                        "qtyordered": "quantity_ordered", "qtyfulfilled": "quantity_fulfilled", "qtytofulfill": "quantity_to_fulfill", "totalprice": "total_price",
                        "totalcost": "total_cost", "typeid": "item_type_id", "statusid": "status_id", "uomid": "uom_id", "customfields": "custom_fields"},
    "fishbowl_po": {"id": "purchase_order_id", "vendorid": "vendor_id", "statusid": "po_status_id", "datecreated": "created_at", "dateconfirmed": "confirmed_at",
                    "dateissued": "issued_at", "datefirstship": "first_ship_date", "locationgroupid": "location_group_id"},
    "fishbowl_poitem": {"id": "po_item_id", "poid": "purchase_order_id", "partid": "part_id", "qtytofulfill": "quantity_ordered", "qtyfulfilled": "quantity_fulfilled",
                        "unitcost": "unit_cost", "totalcost": "total_cost", "typeid": "po_item_type_id", "statusid": "po_item_status_id", "uomid": "uom_id",
                        "datelastfulfillment": "last_fulfillment_date", "datescheduledfulfillment": "scheduled_fulfillment_date"},
    "fishbowl_receipt": {"id": "receipt_id", "ordertypeid": "order_type_id", "locationgroupid": "location_group_id", "typeid": "receipt_type_id", "xoid": "transfer_order_id"},
    "fishbowl_receiptitem": {"id": "receipt_item_id", "receiptid": "receipt_id", "partid": "part_id", "poitemid": "po_item_id", "uomid": "uom_id", "qty": "quantity_received",
                             "statusid": "receipt_item_status_id", "datereceived": "received_at", "datereconciled": "reconciled_at", "datelastmodified": "last_modified_at",
                             "xoitemid": "xo_item_id", "mcbilledtotalcost": "mc_billed_total_cost"},
    "fishbowl_part": {"id": "part_id", "num": "part_number", "uomid": "default_uom_id", "stdcost": "standard_cost", "datecreated": "date_created", "activeflag": "is_active"},
    "fishbowl_product": {"id": "product_id", "num": "product_number", "partid": "part_id", "uomid": "uom_id", "kitflag": "is_kit", "datelastmodified": "last_modified_at"},
    "fishbowl_partcost": {"partid": "part_id", "avgcost": "average_cost", "qty": "quantity"},
    "fishbowl_uomconversion": {"id": "uom_conversion_id", "fromuomid": "from_uom_id", "touomid": "to_uom_id", "multiply": "multiply_factor", "factor": "factor", "description": "conversion_description"},
    "fishbowl_plugininfo": {"recordid": "record_id", "channelid": "channel_id", "tablename": "related_table_name"},
    "fishbowl_objecttoobject": {"typeid": "relationship_type_id", "recordid1": "object1_record_id", "recordid2": "object2_record_id", "note": "relationship_note"},
    "fishbowl_tag": {"id": "tag_id", "num": "tag_number", "partid": "part_id", "locationid": "location_id", "typeid": "tag_type_id", "qty": "quantity_on_tag", "qtycommitted": "quantity_committed_on_tag"},
    "fishbowl_location": {"id": "location_id", "locationgroupid": "location_group_id", "typeid": "location_type_id", "pickable": "is_pickable", "countedasavailable": "is_counted_as_available"},
    "fishbowl_tagserialview": {"tagid": "tag_id", "serialnum": "serial_number_value", "typeid": "part_tracking_type_id", "name": "part_tracking_name", "serialid": "serial_id"},
    "fishbowl_serial": {"id": "serial_id", "tagid": "tag_id", "committedflag": "is_committed"},
    "fishbowl_serialnum": {"id": "serial_num_record_id", "serialid": "serial_number_id", "parttrackingid": "part_tracking_id", "serialnum": "serial_number_value"},
    "fishbowl_parttracking": {"id": "part_tracking_id", "name": "part_tracking_name", "abbr": "part_tracking_abbreviation", "sortorder": "sort_order", "activeflag": "is_active"},
    "fishbowl_ship": {"id": "shipment_id", "soid": "sales_order_id", "carrierserviceid": "carrier_service_id", "dateshipped": "shipped_at"},
    "fishbowl_shipcarton": {"shipid": "shipment_id", "trackingnum": "tracking_number", "freightamount": "freight_amount", "freightweight": "freight_weight"},
    "fishbowl_carrierservice": {"id": "carrier_service_id", "carrierid": "carrier_id", "name": "carrier_service_name", "code": "carrier_service_code"},
    "fishbowl_kititem": {"kitproductid": "kit_product_id", "productid": "component_product_id", "kittypeid": "kit_type_id", "defaultqty": "default_quantity"},
    "fishbowl_wo": {"id": "work_order_id", "statusid": "status_id", "locationgroupid": "location_group_id", "calcategoryid": "calendar_category_id"},
    "fishbowl_woitem": {"woid": "work_order_id", "partid": "part_id", "typeid": "item_type_id", "qtytarget": "quantity_target", "uomid": "uom_id"},
    "fishbowl_xo": {"id": "transfer_order_id", "statusid": "status_id", "fromlgid": "from_location_group_id", "shiptolgid": "to_location_group_id"},
    "fishbowl_xoitem": {"xoid": "transfer_order_id", "partid": "part_id", "typeid": "item_type_id", "statusid": "item_status_id", "qtytofulfill": "quantity_to_fulfill"},
    "fishbowl_vendors": {"id": "vendor_id", "name": "vendor_name", "leadtime": "lead_time_days", "datelastmodified": "date_last_modified", "defaultcarrierserviceid": "default_carrier_service_id"},
    "fishbowl_customers": {"id": "customer_id", "number": "customer_number", "taxexempt": "is_tax_exempt", "datecreated": "date_created"},
    "magento_sales_order": {"entity_id": "order_id", "increment_id": "order_increment_id", "status": "order_status", "customer_email": "customer_email"},
    "magento_sales_order_item": {"item_id": "order_item_id", "qty_ordered": "quantity_ordered", "vendor": "vendor_id", "weight": "item_weight", "created_at": "item_created_at"},
    "magento_sales_order_address": {"entity_id": "order_address_id", "country_id": "country_code", "street": "street_address", "telephone": "phone_number"},
    "magento_catalog_product_entity": {"entity_id": "product_entity_id", "sku": "sku"},
    "magento_quote_shipping_rate": {"code": "quote_shipping_rate_code", "address_id": "quote_address_id"},
    "magento_customer_entity": {"entity_id": "customer_id", "group_id": "customer_group_id", "firstname": "first_name"},
    "magento_sales_shipment_grid": {"shipment_status": "shipment_status_code", "shipping_address": "shipping_address_text"},
    "magento_store": {"store_id": "store_id", "name": "store_name", "code": "store_code"},
}


@pytest.mark.parametrize("model", sorted(NEEDED))
def test_names(model):
    names, _ = silver.output_names(model, list(NEEDED[model]))
    assert names == NEEDED[model]


def test_all_models_are_covered():
    assert len(silver.ERP) == 34
    assert len(silver.LANDING) + 1 == 34 + 23  # the customer identity has its own builder
    assert split_words("defaultoutsourcedreturnitemid") == ("default", "outsourced", "return", "item", "id")


@pytest.mark.parametrize("model", sorted(silver.LANDING))
def test_every_model_cleans_its_log(spark, model):
    spec = silver.ERP.get(model) or silver.SHOP[model]
    key = spec.key or "tracking_number"
    columns = [key, *[c for c in (spec.keep or (*list(spec.names)[:3], *spec.flags)) if c != key]]
    columns = list(dict.fromkeys(columns))
    base = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, version int")
    landing = base.select(*[F.col("k" if c == key else "version").alias(c) for c in columns], (F.col("version") * 1000).cast("long").alias("_airbyte_extracted_at"))
    if spec.tombstones:
        landing = landing.withColumns({"_ab_cdc_deleted_at": F.lit(None).cast("string"), "_ab_cdc_updated_at": F.lit(None).cast("string")})
    clean = silver.clean(model, landing)
    assert clean.count() == (3 if spec.key is None else 2)
    kept = {"_ab_cdc_updated_at"} if model in silver.KEEPS_LOG else set()
    assert {c for c in clean.columns if c.startswith("_a")} == kept
    flags = silver.output_names(model, columns)[1]
    types = dict(clean.dtypes)
    assert all(types[silver.output_names(model, columns)[0][f]] == "boolean" for f in flags)


def test_columns_without_known_words_are_told(spark):
    import warnings

    import pytest

    from stocktally.sources import silver

    landing = spark.createDataFrame([(1, "n", "q", None, 1)], "id int, num string, zzqx string, _ab_cdc_deleted_at string, _airbyte_extracted_at long")
    with pytest.warns(UserWarning, match="fishbowl_so: no clean name is known for zzqx"):
        assert "zzqx" in silver.clean("fishbowl_so", landing).columns
    with pytest.raises(ValueError, match="zzqx"):
        silver.clean("fishbowl_so", landing, unknown="raise")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        silver.clean("fishbowl_so", landing.drop("zzqx"))
        silver.clean("fishbowl_so", landing, unknown="keep")
    assert all(not silver.unknown_columns(m, [*s.names, *s.keep, *s.flags]) for m, s in silver.ERP.items())
