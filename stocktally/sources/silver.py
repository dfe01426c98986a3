"""The cleaned tables: which landing table, which key, which names and flags."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.operators.cdc import METADATA, cdc_latest
from stocktally.operators.identity import customer_identity
from stocktally.sources.naming import erp_name, shop_name, unsplit
from stocktally.sources.tables import Tables


@dataclass(frozen=True)
class Clean:
    """How one landing table becomes one cleaned table.

    names overrides the naming rule, leave lists columns left out; flags are cast to boolean; keep lists the only
    columns to project when the model is narrower than its source.
    """

    source: str
    key: str | None = "id"
    entity: str = ""
    noun: str | None = None
    kind: str | None = None
    state: str | None = None
    dates: str = "at"
    names: Mapping[str, str] = field(default_factory=dict)
    flags: tuple[str, ...] = ()
    cast_flags: bool = True
    keep: tuple[str, ...] = ()
    leave: tuple[str, ...] = ()  # source columns that the model does not have
    drop_null_keys: bool = False
    tombstones: bool = True


# Naming overrides and flags of the cleaned ERP tables.
ERP: dict[str, Clean] = {
    "fishbowl_carrierservice": Clean("carrierservice", entity="carrier_service", names={"readonly": "is_readonly"}, flags=("readonly",)),
    "fishbowl_customers": Clean("customer", entity="customer", dates="prefix", cast_flags=False, names={"taxexempt": "is_tax_exempt"}),
    "fishbowl_inventorylog": Clean("inventorylog", entity="inventory_log", kind="log", names={
        "tableid": "related_table_id", "recordid": "related_record_id", "changeqty": "quantity_changed",
        "qtyonhand": "quantity_on_hand_after_change", "cost": "cost_of_change", "eventdate": "event_timestamp",
        "datecreated": "record_created_at", "info": "log_info"}),
    "fishbowl_kititem": Clean("kititem", entity="kit_item", names={
        "productid": "component_product_id", "soitemtypeid": "default_so_item_type_id", "qtypriceadjustment": "quantity_price_adjustment"}),
    "fishbowl_location": Clean("location", entity="location", names={
        "parentid": "parent_location_id", "defaultflag": "is_default_location", "pickable": "is_pickable",
        "receivable": "is_receivable", "countedasavailable": "is_counted_as_available"},
        flags=("pickable", "receivable", "countedasavailable")),
    "fishbowl_objecttoobject": Clean("objecttoobject", entity="object_relationship", noun="relationship", kind="relationship", names={
        "tableid1": "object1_view_id", "recordid1": "object1_record_id", "tableid2": "object2_view_id", "recordid2": "object2_record_id"}),
    "fishbowl_part": Clean("part", entity="part", dates="prefix", cast_flags=False, names={
        "upc": "upc_code", "details": "part_details", "uomid": "default_uom_id", "stdcost": "standard_cost",
        "revision": "revision_number", "configurable": "is_configurable", "trackingflag": "has_tracking",
        "receivingtol": "receiving_tolerance", "cyclecounttol": "cycle_count_tolerance", "pickinuomofpart": "pick_in_uom_of_part"}),
    "fishbowl_partcost": Clean("partcost", entity="part_cost"),
    "fishbowl_parttotracking": Clean("parttotracking", entity="part_to_tracking", names={
        "nextvalue": "next_tracking_value", "primaryflag": "is_primary_tracking"}),
    "fishbowl_parttracking": Clean("parttracking", entity="part_tracking", names={"abbr": "part_tracking_abbreviation", "gs1code": "gs1_code"}),
    "fishbowl_plugininfo": Clean("plugininfo", entity="plugin_info", names={
        "plugin": "plugin_name", "info": "plugin_info_data", "tablename": "related_table_name"}),
    "fishbowl_po": Clean("po", entity="purchase_order", noun="po", kind="po", state="po", names={
        "vendorso": "vendor_sales_order_number", "vendorcontact": "vendor_contact_name", "email": "vendor_email", "phone": "vendor_phone",
        "buyer": "buyer_name", "issuedbyuserid": "issued_by_user_id", "totalincludestax": "is_total_including_tax",
        "deliverto": "deliver_to_location_name", "customerso": "customer_so_number", "remitaddress": "remit_to_address",
        "remitcity": "remit_to_city", "remitzip": "remit_to_zip", "remitstateid": "remit_to_state_id",
        "remitcountryid": "remit_to_country_id"}, flags=("totalincludestax",)),
    "fishbowl_poitem": Clean("poitem", entity="po_item", noun="item", kind="po_item", state="po_item", names={
        "polineitem": "po_line_item_number", "qtytofulfill": "quantity_ordered", "tbdcostflag": "is_cost_tbd", "repairflag": "is_repair_item"}),
    "fishbowl_post": Clean("post", entity="post", kind="post", state="post", names={
        "amount": "post_amount", "quantity": "posted_quantity", "datecreated": "record_created_at"}),
    "fishbowl_postpo": Clean("postpo", entity="post_po", state="post", names={
        "postdate": "post_date", "journalposted": "is_journal_posted", "dateposted": "posted_to_accounting_at",
        "datecreated": "record_created_at"}, flags=("journalposted",)),
    "fishbowl_postpoitem": Clean("postpoitem", entity="post_po_item", names={
        "postpoid": "post_po_id", "poitemid": "po_item_id", "receiptitemid": "receipt_item_id", "shipitemid": "ship_item_id",
        "qty": "quantity_posted", "stdcost": "standard_cost_at_posting", "datecreated": "record_created_at"}),
    "fishbowl_product": Clean("product", entity="product", names={
        "sku": "product_sku", "upc": "product_upc", "details": "product_details", "price": "unit_price", "usepriceflag": "use_list_price",
        "kitgroupedflag": "is_kit_grouped", "showsocomboflag": "show_on_so_combo", "sellableinotheruoms": "is_sellable_in_other_uoms",
        "defaultsoitemtype": "default_so_item_type_id"}, flags=("sellableinotheruoms",)),
    "fishbowl_receipt": Clean("receipt", entity="receipt", state="receipt"),
    "fishbowl_receiptitem": Clean("receiptitem", entity="receipt_item", state="receipt_item", names={
        "reason": "reason_code", "refno": "reference_number", "deliverto": "deliver_to_location", "qty": "quantity_received",
        "billvendorflag": "bill_vendor_flag"}),
    "fishbowl_serial": Clean("serial", entity="serial"),
    "fishbowl_serialnum": Clean("serialnum", entity="serial_num_record", names={"serialid": "serial_number_id", "serialnum": "serial_number_value"}),
    "fishbowl_ship": Clean("ship", entity="shipment", names={
        "contact": "shipment_contact", "shippedby": "shipped_by_user_id", "billoflading": "bill_of_lading",
        "shiptoresidential": "is_ship_to_residential", "ownerisfrom": "owner_is_from"}, flags=("shiptoresidential", "ownerisfrom")),
    "fishbowl_shipcarton": Clean("shipcarton", entity="ship_carton", names={
        "cartonnum": "carton_number", "sscc": "sscc_code", "additionalhandling": "requires_additional_handling",
        "shipperrelease": "is_shipper_release"}, flags=("additionalhandling", "shipperrelease")),
    "fishbowl_so": Clean("so", entity="sales_order", kind="order", names={
        "note": "note", "url": "url", "cost": "total_cost", "totalincludestax": "is_total_including_tax", "customerpo": "customer_po_number",
        "customercontact": "customer_contact_name", "email": "customer_email", "phone": "customer_phone",
        "shiptoresidential": "is_ship_to_residential", "salesman": "salesman_name", "vendorpo": "vendor_po_number"},
        flags=("totalincludestax", "shiptoresidential", "tobeemailed", "tobeprinted")),
    "fishbowl_soitem": Clean("soitem", entity="so_item", noun="product", kind="item", names={
        "note": "note", "solineitem": "line_item_number", "productnum": "product_number", "adjustamount": "adjustment_amount",
        "adjustpercentage": "adjustment_percentage", "itemadjustid": "item_adjustment_id", "showitemflag": "show_item",
        "exchangesolineitem": "exchange_so_line_item"}),
    "fishbowl_tag": Clean("tag", entity="tag", names={
        "woitemid": "work_order_item_id", "qty": "quantity_on_tag", "qtycommitted": "quantity_committed_on_tag",
        "serializedflag": "is_serialized_item_on_tag"}),
    "fishbowl_tagserialview": Clean("tagserialview", key="tagid", entity="part_tracking", tombstones=False, names={
        "serialnumid": "serial_num_record_id", "serialnum": "serial_number_value", "abbr": "part_tracking_abbreviation",
        "sortorder": "part_tracking_sort_order", "activeflag": "is_part_tracking_active", "committedflag": "is_serial_committed"}),
    "fishbowl_uomconversion": Clean("uomconversion", entity="uom_conversion", noun="conversion", names={"multiply": "multiply_factor"}),
    "fishbowl_vendor_parts": Clean("vendorparts", keep=("id", "partid", "datelastmodified", "lastcost")),
    "fishbowl_vendors": Clean("vendor", entity="vendor", dates="prefix", cast_flags=False, names={"minorderamount": "minimum_order_amount"}),
    "fishbowl_wo": Clean("wo", entity="work_order", names={
        "cost": "total_cost", "datescheduled": "scheduled_completion_date", "datescheduledtostart": "scheduled_start_date"}),
    "fishbowl_woitem": Clean("woitem", entity="wo_item", noun="item", kind="item", names={
        "sortid": "sort_order", "cost": "actual_cost", "onetimeitem": "is_one_time_item"}, flags=("onetimeitem",)),
    "fishbowl_xo": Clean("xo", entity="transfer_order", names={
        "ownerisfrom": "owner_is_from_location", "fromname": "from_location_name", "fromzip": "from_zip_code", "shiptoname": "to_location_name",
        "shiptoaddress": "to_address", "shiptocity": "to_city", "shiptostateid": "to_state_id", "shiptozip": "to_zip_code",
        "shiptocountryid": "to_country_id", "shiptoattn": "to_attention", "mainlocationtagid": "main_to_location_tag_id",
        "datescheduled": "scheduled_transfer_date", "datefirstship": "first_shipment_date"}, flags=("ownerisfrom",)),
    "fishbowl_xoitem": Clean("xoitem", entity="xo_item", noun="item", kind="item", state="item", names={"lineitem": "line_item_number"}),
}

# Names shared by the shop's address-like tables.
PERSON = {
    "firstname": "first_name", "middlename": "middle_name", "lastname": "last_name", "prefix": "name_prefix", "suffix": "name_suffix",
    "street": "street_address", "country_id": "country_code", "telephone": "phone_number", "fax": "fax_number",
}
_EAV_VALUE = ("value_id", "entity_id", "attribute_id", "store_id", "value")

# Naming overrides and flags of the cleaned shop tables.
SHOP: dict[str, Clean] = {
    "magento_catalog_category_entity_varchar": Clean("catalog_category_entity_varchar", "value_id", keep=("value_id", "entity_id", "attribute_id", "value")),
    "magento_catalog_category_product": Clean("catalog_category_product", "entity_id", keep=("entity_id", "category_id", "product_id")),
    "magento_catalog_product_entity": Clean("catalog_product_entity", "entity_id", names={"entity_id": "product_entity_id"},
        flags=("has_options", "required_options"), drop_null_keys=True),
    **{f"magento_catalog_product_entity_{k}": Clean(f"catalog_product_entity_{k}", "value_id", keep=_EAV_VALUE) for k in ("decimal", "int", "text", "varchar")},
    "magento_catalog_product_super_link": Clean("catalog_product_super_link", "link_id", keep=("link_id", "product_id", "parent_id")),
    "magento_customer_entity": Clean("customer_entity", "entity_id", names={
        **PERSON, "entity_id": "customer_id", "increment_id": "customer_increment_id", "group_id": "customer_group_id", "dob": "date_of_birth",
        "taxvat": "tax_vat_number", "default_billing": "default_billing_address_id", "default_shipping": "default_shipping_address_id",
        "confirmation": "confirmation_token", "failures_num": "login_failures_count", "first_failure": "first_login_failure_at",
        "lock_expires": "account_lock_expires_at", "rp_token": "password_reset_token", "rp_token_created_at": "password_reset_token_created_at",
        "created_at": "customer_created_at", "updated_at": "customer_updated_at", "created_in": "created_in_store_view",
        "disable_auto_group_change": "is_auto_group_change_disabled", "mp_smtp_email_marketing_synced": "is_mp_smtp_email_marketing_synced"},
        flags=("is_active", "disable_auto_group_change", "mp_smtp_email_marketing_synced")),
    "magento_eav_attribute": Clean("eav_attribute", "attribute_id", keep=("attribute_id", "attribute_code")),
    "magento_eav_attribute_option_value": Clean("eav_attribute_option_value", "option_id", keep=("option_id", "store_id", "value")),
    "magento_eav_attribute_set": Clean("eav_attribute_set", "attribute_set_id", keep=("attribute_set_id", "attribute_set_name")),
    "magento_quote": Clean("quote", "entity_id"),
    "magento_quote_address": Clean("quote_address", "address_id", names={
        **PERSON, "address_id": "quote_address_id", "free_shipping": "has_free_shipping", "collect_shipping_rates": "should_collect_shipping_rates",
        "vat_is_valid": "is_vat_valid", "vat_request_success": "was_vat_request_successful", "same_as_billing": "is_same_as_billing",
        "save_in_address_book": "should_save_in_address_book", "is_ffl": "is_ffl_address", "is_checkout": "is_checkout_address",
        "split_rates": "has_split_rates", "smsoptin_check": "sms_optin_check", "checkout_display_merged": "is_checkout_display_merged",
        "weight": "total_weight", "created_at": "address_created_at", "updated_at": "address_updated_at"},
        flags=("free_shipping", "collect_shipping_rates", "vat_is_valid", "vat_request_success", "same_as_billing", "save_in_address_book",
               "is_ffl", "is_checkout", "split_rates", "smsoptin_check", "aw_afptc_uses_coupon", "checkout_display_merged")),
    "magento_quote_address_item": Clean("quote_address_item", "address_item_id", names={
        "is_qty_decimal": "is_quantity_decimal", "no_discount": "is_discount_excluded", "free_shipping": "has_free_shipping",
        "address_item_id": "quote_address_item_id", "name": "product_name", "description": "product_description", "image": "image_url",
        "weight": "item_weight", "qty": "quantity", "price": "unit_price", "price_incl_tax": "unit_price_incl_tax",
        "base_price_incl_tax": "base_unit_price_incl_tax"},
        flags=("is_qty_decimal", "no_discount", "free_shipping")),
    "magento_quote_shipping_rate": Clean("quote_shipping_rate", "rate_id", names={
        "code": "quote_shipping_rate_code", "rate_id": "quote_shipping_rate_id", "address_id": "quote_address_id", "carrier_id": "carrier_service_id"}),
    "magento_sales_order": Clean("sales_order", "entity_id", names={
        "entity_id": "order_id", "increment_id": "order_increment_id", "ext_order_id": "external_order_id", "ext_customer_id": "external_customer_id",
        "state": "order_state", "status": "order_status", "customer_is_guest": "is_customer_guest",
        "customer_note_notify": "should_notify_customer_note", "forced_shipment_with_invoice": "has_forced_shipment_with_invoice",
        "is_virtual": "is_virtual_order", "email_sent": "is_email_sent", "send_email": "should_send_email",
        "sent_to_measurement": "is_sent_to_measurement", "route_is_insured": "is_route_insured",
        "mp_smtp_email_marketing_synced": "is_mp_smtp_email_marketing_synced",
        "mp_smtp_email_marketing_order_created": "is_mp_smtp_email_marketing_order_created"},
        leave=("total_invoiced", "base_total_invoiced", "store_currency_code", "base_total_qty_ordered"),
        flags=("customer_is_guest", "customer_note_notify", "can_ship_partially", "can_ship_partially_item", "forced_shipment_with_invoice",
               "is_virtual", "email_sent", "send_email", "sent_to_measurement", "aw_afptc_uses_coupon", "route_is_insured",
               "is_sportsouth_failed", "is_sportssouth_order", "mp_smtp_email_marketing_synced", "mp_smtp_email_marketing_order_created")),
    "magento_sales_order_address": Clean("sales_order_address", "entity_id", names={
        **PERSON, "entity_id": "order_address_id", "parent_id": "order_id", "vat_is_valid": "is_vat_valid",
        "vat_request_success": "was_vat_request_successful", "smsoptin_check": "sms_optin_check"}, flags=("vat_is_valid", "vat_request_success")),
    "magento_sales_order_item": Clean("sales_order_item", "item_id", names={
        "item_id": "order_item_id", "ext_order_item_id": "external_order_item_id", "vendor": "vendor_id", "name": "product_name",
        "description": "product_description", "weight": "item_weight", "is_qty_decimal": "is_quantity_decimal", "price": "unit_price",
        "original_price": "unit_original_price", "price_incl_tax": "unit_price_incl_tax", "base_price": "base_unit_price",
        "base_original_price": "base_unit_original_price", "base_price_incl_tax": "base_unit_price_incl_tax", "is_virtual": "is_virtual_item",
        "no_discount": "is_discount_excluded", "free_shipping": "has_free_shipping", "locked_do_ship": "is_locked_for_shipping",
        "locked_do_invoice": "is_locked_for_invoicing", "gift_message_available": "is_gift_message_available",
        "created_at": "item_created_at", "updated_at": "item_updated_at", "aw_afptc_is_promo": "is_aw_afptc_promo"},
        flags=("is_qty_decimal", "is_virtual", "no_discount", "free_shipping", "locked_do_ship", "locked_do_invoice",
               "gift_message_available", "requires_ffl", "aw_afptc_is_promo")),
    "magento_sales_shipment_grid": Clean("sales_shipment_grid", "entity_id", names={
        "entity_id": "shipment_grid_id", "increment_id": "shipment_increment_id", "total_qty": "total_quantity_shipped",
        "shipment_status": "shipment_status_code", "shipping_address": "shipping_address_text", "billing_address": "billing_address_text",
        "created_at": "shipment_created_at", "updated_at": "shipment_updated_at"}),
    "magento_store": Clean("store", "store_id", names={"name": "store_name", "code": "store_code"}, flags=("is_active",)),
    "magento_ups_invoice": Clean("ups_invoice", None, keep=("tracking_number", "net_amount"), tombstones=False),
}

# Models that carry the change-log position along, and its columns.
LOG_COLUMNS = ("_ab_cdc_cursor", "_ab_cdc_log_pos", "_ab_cdc_log_file", "_ab_cdc_updated_at")
KEEPS_LOG = frozenset("""
fishbowl_inventorylog fishbowl_kititem fishbowl_parttotracking fishbowl_parttracking fishbowl_po fishbowl_poitem
fishbowl_post fishbowl_postpo fishbowl_postpoitem fishbowl_receipt fishbowl_receiptitem fishbowl_serial
fishbowl_serialnum fishbowl_wo fishbowl_woitem fishbowl_xo fishbowl_xoitem magento_customer_entity
magento_quote_address magento_quote_address_item
""".split())

# (source system, landing table) of every cleaned table.
LANDING = {
    **{m: ("fishbowl", c.source) for m, c in ERP.items()},
    **{m: ("ups" if c.source == "ups_invoice" else "magento", c.source) for m, c in SHOP.items()},
}


def project_spec(df: DataFrame, names: Mapping[str, str], flags: tuple[str, ...] = ()) -> DataFrame:
    """Rename columns and turn 0/1 flags into booleans."""
    return df.select([
        (F.col(f"`{c}`").cast("boolean") if c in flags else F.col(f"`{c}`")).alias(out) for c, out in names.items()
    ])


def output_names(model: str, columns: list[str]) -> tuple[dict[str, str], tuple[str, ...]]:
    """Output name per landing column and the flag columns of a model."""
    erp = model in ERP
    spec = ERP[model] if erp else SHOP[model]
    names: dict[str, str] = {}
    flags = [c for c in spec.flags if spec.cast_flags]
    for column in columns:
        low = column.lower()
        if model in KEEPS_LOG and low in LOG_COLUMNS:
            names[column] = low
            continue
        if low in METADATA or low in spec.leave or (spec.keep and low not in spec.keep):
            continue
        if spec.keep:
            names[column] = low
        elif erp:
            name, is_flag = erp_name(low, spec.entity, spec.noun, spec.kind, spec.state, spec.dates)
            names[column] = spec.names.get(low, name)
            if is_flag and spec.cast_flags:
                flags.append(low)
        else:
            names[column] = spec.names.get(low, shop_name(low))
    return names, tuple(c for c in columns if c.lower() in flags)


def unknown_columns(model: str, columns: list[str]) -> list[str]:
    """Landing columns of an ERP model that neither its list nor the naming rule can name."""
    if model not in ERP:
        return []
    spec = ERP[model]
    listed = {*spec.names, *spec.keep, *spec.leave, *LOG_COLUMNS, *METADATA}
    return [c for c in columns if c.lower() not in listed and not spec.keep and unsplit(c) is not None]


def clean(model: str, landing: DataFrame, tombstone_mode: str = "filter_first", unknown: str = "warn") -> DataFrame:
    """Newest live version of every key, with clean names and types.

    A landing column whose words are not known passes under its raw name: with a warning, or, unknown="raise", not at all.
    """
    spec = ERP.get(model) or SHOP[model]
    strange = unknown_columns(model, landing.columns) if unknown != "keep" else []
    if strange:
        said = f"{model}: no clean name is known for {', '.join(strange)}"
        if unknown == "raise":
            raise ValueError(said)
        warnings.warn(said, stacklevel=2)
    names, flags = output_names(model, landing.columns)
    live = landing
    if spec.key is not None:
        live = cdc_latest(landing, [spec.key], tombstone_mode=tombstone_mode, drop_null_keys=spec.drop_null_keys)
    return project_spec(live, names, flags)


def builders(landing: Mapping[str, DataFrame], cfg: RetailConfig = DEFAULT) -> dict:
    """Cleaned tables from landing tables keyed ``system.table``."""
    result = {m: (lambda t, m=m, k=f"{s}.{tab}": clean(m, landing[k])) for m, (s, tab) in LANDING.items() if f"{s}.{tab}" in landing}
    if "magento.sales_order" in landing:
        # Built on every order record, deleted ones included.
        result["magento_d_customerupdated"] = lambda t: customer_identity(
            landing["magento.sales_order"], "customer_email", cfg.default_customer_email
        )
    return result
