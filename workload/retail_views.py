"""Retail and ERP tables derived from the given star-schema tables.

Every view is one SQL text that Spark and DuckDB both run, with other tables named in
braces. Line items are an append-only change log of order lines (several records per
order and line number); ``items`` is its cleaned state and is built by the change-log
operator on the Spark side.
"""

from __future__ import annotations

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_EMAIL = """case c_mktsegment when 'FURNITURE' then '' when 'MACHINERY' then c_name || '@mail.test'
 else lower(c_name) || '@mail.test' end"""
# Columns that no other view reads: every one is filled, so that the dimensions can be compared whole.
_CUSTOMER_REST = ",\n ".join(f"c_name || ':{c}' as {c}" for c in (
    "date_of_birth", "gender", "name_prefix", "name_suffix", "tax_vat_number", "customer_created_at", "created_in_store_view", "middle_name",
    "customer_updated_at", "website_id", "confirmation_token", "login_failures_count", "customer_increment_id", "account_lock_expires_at",
    "first_login_failure_at", "password_hash", "_ab_cdc_cursor", "session_cutoff", "_ab_cdc_log_pos", "default_billing_address_id", "is_zendesk_user",
    "default_shipping_address_id", "password_reset_token_created_at", "is_auto_group_change_disabled", "is_mp_smtp_email_marketing_synced",
))
_VENDOR_REST = ",\n ".join(f"s_name || ':{c}' as {c}" for c in (
    "vendor_note", "vendor_url", "lead_time_days", "status_id", "account_id", "sysuser_id", "tax_rate_id", "account_number", "is_active", "currency_id",
    "date_entered", "accounting_id", "currency_rate", "custom_fields", "accounting_hash", "minimum_order_amount", "last_changed_user",
    "date_last_modified", "default_carrier_id", "default_ship_terms_id", "default_payment_terms_id", "default_carrier_service_id",
))
_GROUP = "cast(substr(o_orderpriority, 1, 1) as int)"
_UOM = "case l_linenumber when 3 then 2 when 4 then 3 else 1 end"
_ZIP = "lpad(cast((c_nationkey + 1) * 3947 as string), 5, '0')"

VIEWS: dict[str, str] = {
    "item_log": """select l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber as item_id, l_partkey, l_suppkey, l_quantity,
 l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate from {lineitem}""",
    # --- shop ---
    "magento_sales_order": f"""select o_orderkey as order_id, cast(o_orderkey as string) as order_increment_id,
 case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'canceled' when o_orderstatus = 'F' then 'complete'
      when o_orderstatus = 'O' then 'processing' else 'unverified' end as order_status,
 {_EMAIL} as customer_email, o_custkey as customer_id, c_mktsegment as customer_firstname, c_name as customer_lastname,
 o_custkey as billing_address_id, o_custkey as shipping_address_id, c_nationkey as store_id, o_orderkey as quote_id,
 'Store ' || cast(c_nationkey as string) as store_name, o_orderdate as created_at, o_totalprice / 1000 as base_subtotal,
 o_totalprice * 0.01 as shipping_amount, o_totalprice * 0.01 as base_shipping_amount,
 case when o_orderstatus = 'P' then o_totalprice * 0.01 end as base_shipping_canceled,
 o_totalprice * 0.02 as base_shipping_discount_amount,
 case when o_orderstatus = 'F' then o_totalprice * 0.03 end as base_shipping_refunded,
 o_totalprice * 0.01 as base_shipping_tax_amount, case when o_orderstatus = 'F' then o_totalprice * 0.05 end as base_shipping_tax_refunded,
 o_orderpriority as shipping_method, 'Ship ' || o_orderpriority as shipping_description
 from {{orders}} join {{customer}} on o_custkey = c_custkey""",
    "magento_sales_order_item": """select item_id as order_item_id, l_orderkey as order_id, l_partkey as product_id,
 case when l_linenumber = 2 then l_orderkey * 10 + 1 end as parent_item_id,
 case l_linenumber when 1 then 'configurable' when 6 then 'bundle' when 7 then cast(null as string) else 'simple' end as product_type,
 case when l_linenumber = 7 and l_quantity = 50 then '00-Marketing' when l_linenumber = 5 and l_quantity <= 5 then 'ParcelDefender'
      else 'P' || cast(l_partkey as string) end as sku,
 l_extendedprice as row_total, l_quantity as quantity_ordered, l_extendedprice * l_discount as discount_amount,
 l_extendedprice * l_discount as discount_invoiced, case when l_returnflag = 'R' then l_extendedprice end as amount_refunded,
 case when l_returnflag = 'R' then l_extendedprice * l_discount end as discount_refunded, l_extendedprice * l_tax as tax_amount,
 case when l_linestatus = 'O' and l_linenumber = 4 then cast(null as double) else l_quantity * 0.5 end as item_weight,
 l_extendedprice * 0.6 as base_cost, l_shipdate as item_created_at, l_linenumber as store_id, l_suppkey as vendor_id,
 cast(null as string) as product_options from {items}""",
    "magento_sales_order_address": f"""select c_custkey as order_address_id, 'shipping' as address_type, {_ZIP} as postcode, 'US' as country_code,
 case when c_mktsegment = 'BUILDING' then cast(null as string) else n_name end as region, 'City ' || cast(c_nationkey as string) as city,
 'Street ' || cast(c_custkey as string) as street_address, 'T' || cast(c_custkey as string) as phone_number
 from {{customer}} join {{nation}} on c_nationkey = n_nationkey""",
    "magento_catalog_product_entity": """select p_partkey as product_entity_id, p_size as attribute_set_id, 'simple' as type_id,
 case when p_size = 2 then 'PARCELDEFENDER-' || cast(p_partkey as string) else 'P' || cast(p_partkey as string) end as sku,
 p_size > 25 as has_options, p_size > 40 as required_options from {part}""",
    "magento_eav_attribute": """select * from (values (1, 'name'), (2, 'suggested_use'), (3, 'url_key'), (4, 'image'), (5, 'caliber'),
 (6, 'manufacturer_sku'), (7, 'optic_coating'), (8, 'price'), (9, 'status'), (10, 'not_listed')) as a(attribute_id, attribute_code)""",
    "magento_catalog_product_entity_varchar": """select p_partkey * 100 + 1 as value_id, p_partkey as entity_id, 1 as attribute_id, 0 as store_id, p_name as value from {part}
 union all select p_partkey * 100 + 2, p_partkey, 3, 0, 'p-' || cast(p_partkey as string) from {part}
 union all select p_partkey * 100 + 3, p_partkey, 4, 0, '/' || cast(p_size as string) || '.jpg' from {part}
 union all select p_partkey * 100 + 4, p_partkey, 5, 0, ' ' || p_type from {part}
 union all select p_partkey * 100 + 5, p_partkey, 6, 0, p_brand || ' ' from {part}
 union all select p_partkey * 100 + 6, p_partkey, 152, 0, 'R' || cast(p_size as string) from {part}
 union all select p_partkey * 100 + 7, p_partkey, 188, 0, case when p_size > 30 then 'steel' else 'brass' end from {part}
 union all select p_partkey * 100 + 8, p_partkey, 1, 1, 'other store' from {part}""",
    "magento_catalog_product_entity_text": """select p_partkey * 100 + 1 as value_id, p_partkey as entity_id, 2 as attribute_id, 0 as store_id,
 case when p_size > 45 then 'Range and Sport' else 'Everyday' end as value from {part}
 union all select p_partkey * 100 + 2, p_partkey, 7, 0, 'Coating ' || p_type from {part}
 union all select p_partkey * 100 + 3, p_partkey, 682, 0, '3, 1,x,' || cast(p_size as string) || ',1' from {part}""",
    "magento_catalog_product_entity_decimal": """select p_partkey * 100 + 1 as value_id, p_partkey as entity_id, 8 as attribute_id, 0 as store_id,
 cast(p_retailprice as decimal(20, 6)) as value from {part}""",
    "magento_catalog_product_entity_int": """select p_partkey * 100 + 1 as value_id, p_partkey as entity_id, 677 as attribute_id, 0 as store_id, p_size as value from {part}
 union all select p_partkey * 100 + 2, p_partkey, 678, 0, 100 + cast(floor(p_size / 8) as int) from {part}
 union all select p_partkey * 100 + 3, p_partkey, 681, 0, 110 + cast(floor(p_size / 9) as int) from {part}
 union all select p_partkey * 100 + 4, p_partkey, 878, 0, case p_type when 'PROMO' then 3 when 'LARGE' then 4 else 5 end from {part}
 union all select p_partkey * 100 + 5, p_partkey, 145, 0, case p_brand when 'Brand#1' then 7 else 8 end from {part}""",
    "magento_eav_attribute_option_value": """select n_nationkey as option_id, 0 as store_id, n_name as value from {nation}
 union all select * from (values (100, 0, '9mm'), (101, 0, '22 LR'), (102, 0, '12 Gauge'), (103, 0, '308/7.62'), (104, 0, '223/5.56'),
 (105, 0, '45 LC'), (106, 0, '6mm Creedmoor'), (110, 0, 'FMJ'), (111, 0, 'JHP'), (112, 0, 'SP'), (113, 0, '00 Buck'), (114, 0, 'HP'),
 (115, 0, 'Slug')) as o(option_id, store_id, value)""",
    "magento_eav_attribute_set": "select distinct p_size as attribute_set_id, ' Set ' || cast(p_size as string) as attribute_set_name from {part}",
    "magento_catalog_category_product": """select p_partkey * 10 + 1 as entity_id, cast(substr(p_brand, 7) as int) as category_id, p_partkey as product_id from {part}
 union all select p_partkey * 10 + 2, case p_type when 'PROMO' then 101 when 'LARGE' then 102 when 'SMALL' then 103 when 'MEDIUM' then 104 else 105 end, p_partkey from {part}""",
    "magento_catalog_category_entity_varchar": """select distinct cast(substr(p_brand, 7) as int) as value_id, cast(substr(p_brand, 7) as int) as entity_id, 1 as attribute_id, p_brand as value from {part}
 union all select * from (values (101, 101, 1, 'Hunting Gear'), (102, 102, 1, 'Law Enforcement'), (103, 103, 1, 'Collector Items'),
 (104, 104, 1, 'Home Defense'), (105, 105, 1, 'General'), (106, 105, 9, 'not a name')) as c(value_id, entity_id, attribute_id, value)""",
    "magento_catalog_product_super_link": "select item_id as link_id, l_partkey as product_id, l_suppkey as parent_id from {items}",
    "magento_customer_entity": f"""select c_custkey as customer_id, {_EMAIL} as email, n_regionkey as customer_group_id, c_nationkey as store_id,
 c_name as last_name, c_mktsegment as first_name, true as is_active, {_CUSTOMER_REST} from {{customer}} join {{nation}} on c_nationkey = n_nationkey""",
    "magento_quote": "select o_orderkey as entity_id, 'Q' || cast(o_orderkey as string) as ext_shipping_info from {orders}",
    "magento_quote_address": "select o_orderkey as quote_address_id, o_orderkey as quote_id from {orders}",
    "magento_quote_shipping_rate": """select o_orderkey as quote_shipping_rate_id, o_orderkey as quote_address_id, o_orderpriority as quote_shipping_rate_code,
 'M' || o_orderstatus as method, 'Carrier ' || o_orderstatus as carrier_title,
 case when o_orderpriority = '4-NOT SPECIFIED' then 'Mostly free' else 'Paid' end as method_title from {orders}""",
    "magento_sales_shipment_grid": """select o_orderkey as order_id, 1 as shipment_status_code, 'To ' || cast(o_custkey as string) as shipping_address_text,
 'Name ' || cast(o_custkey as string) as shipping_name, o_orderpriority as shipping_information from {orders} where o_orderstatus = 'F'""",
    "magento_store": """select n_nationkey as store_id, n_name as store_name, 's' || cast(n_nationkey as string) as store_code, n_regionkey as group_id,
 true as is_active, n_nationkey as sort_order, n_regionkey as website_id from {nation}""",
    "magento_ups_invoice": """select 'T' || cast(item_id as string) as tracking_number, l_extendedprice * 0.15 as net_amount from {items} where l_returnflag = 'A'
 union all select 'T' || cast(item_id as string), l_extendedprice * 0.01 from {items} where l_returnflag = 'A'""",
    "customer_groups": "select r_regionkey as customer_group_id, r_name as customer_group_code from {region}",
    # --- ERP orders ---
    "fishbowl_so": f"""select o_orderkey as sales_order_id,
 case when o_orderpriority = '1-URGENT' then 'GB' || cast(o_orderkey as string) else cast(o_orderkey as string) || '-1' end as sales_order_number,
 case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 50 when o_orderstatus = 'F' then 60 when o_orderstatus = 'O' then 20 else 25 end as status_id,
 {_EMAIL} as customer_email, 'T' || cast(o_custkey as string) as customer_phone, c_name as bill_to_name,
 'Street ' || cast(o_custkey as string) as bill_to_address, 'City ' || cast(c_nationkey as string) as bill_to_city, {_ZIP} as bill_to_zip,
 o_orderdate as created_at, {_GROUP} as location_group_id from {{orders}} join {{customer}} on o_custkey = c_custkey""",
    "fishbowl_soitem": f"""select item_id as so_item_id, l_orderkey as sales_order_id, l_partkey as product_id, 'P' || cast(l_partkey as string) as product_number,
 case when l_quantity = 1 then 'a PollyAmoBag' else 'goods' end as product_description, l_quantity as quantity_ordered,
 case when l_linestatus = 'F' then l_quantity else 0.0 end as quantity_fulfilled, l_quantity + l_linenumber as quantity_to_fulfill,
 l_extendedprice as total_price, case when l_returnflag = 'A' then 0.0 else l_extendedprice * 0.55 end as total_cost,
 case l_returnflag when 'N' then 10 when 'A' then 12 else 20 end as item_type_id, case when l_linestatus = 'O' then 10 else 30 end as status_id,
 {_UOM} as uom_id,
 case l_linenumber when 4 then cast(null as string) when 6 then 'not json'
  when 5 then concat('{{{{"25": {{{{"value": "', cast(l_orderkey * 10 + 1 as string), '"}}}}}}}}')
  else concat('{{{{"25": {{{{"value": "', cast(item_id as string), '"}}}}}}}}') end as custom_fields from {{items}}""",
    "fishbowl_plugininfo": """select item_id as record_id, cast(item_id as string) as channel_id, 'SOItem' as related_table_name from {items} where l_linenumber = 4
 union all select p_partkey, cast(p_partkey as string), 'Product' from {part}""",
    "fishbowl_objecttoobject": """select item_id as object1_record_id, l_orderkey * 10 + 1 as object2_record_id,
 30 as relationship_type_id from {items} where l_linenumber = 2""",
    "fishbowl_ship": f"select o_orderkey as shipment_id, o_orderkey as sales_order_id, {_GROUP} as carrier_service_id from {{orders}}",
    "fishbowl_shipcarton": """select item_id as ship_carton_id, l_orderkey as shipment_id,
 case when l_linenumber = 7 then cast(null as string) else 'T' || cast(item_id as string) end as tracking_number,
 l_extendedprice * 0.02 as freight_amount, l_quantity * 0.5 as freight_weight from {items}""",
    "fishbowl_carrierservice": "select r_regionkey + 1 as carrier_service_id, r_regionkey + 3 as carrier_id, r_name as carrier_service_name from {region}",
    # --- ERP products ---
    "fishbowl_part": "select p_partkey as part_id, 'P' || cast(p_partkey as string) as part_number, 1 as default_uom_id from {part}",
    "fishbowl_product": """select p_partkey as product_id, 'P' || cast(p_partkey as string) as product_number, p_partkey as part_id,
 case when p_size > 40 then 2 else 1 end as uom_id, p_size = 1 as is_kit from {part}""",
    "fishbowl_partcost": "select p_partkey as part_id, p_retailprice * 0.5 as average_cost from {part}",
    "fishbowl_uomconversion": """select r_regionkey as uom_conversion_id, r_regionkey + 1 as from_uom_id, 1 as to_uom_id,
 r_regionkey * 11.0 + 1.0 as multiply_factor, case r_regionkey when 2 then 0.0 else r_regionkey + 1.0 end as factor from {region}""",
    "fishbowl_kititem": """select item_id as kit_item_id, l_partkey as kit_product_id, l_suppkey as component_product_id,
 case when l_linenumber = 1 then 20 else 10 end as kit_type_id, l_quantity as default_quantity from {items} where l_returnflag = 'N'""",
    "fishbowl_vendor_parts": "select item_id as id, l_partkey as partid, l_shipdate as datelastmodified, l_extendedprice / l_quantity as lastcost from {items}",
    "fishbowl_vendors": f"select s_suppkey as vendor_id, s_name as vendor_name, s_acctbal as credit_limit, {_VENDOR_REST} from {{supplier}}",
    # --- ERP purchasing, transfers, work orders ---
    "order_lines": """select l_orderkey, min(l_suppkey) as supp, min(l_partkey) as part, sum(l_quantity) as qty, max(l_linenumber) as n from {items} group by l_orderkey""",
    "fishbowl_po": f"""select o_orderkey as purchase_order_id, supp as vendor_id, o_orderdate as created_at, o_orderdate as confirmed_at,
 o_orderdate as issued_at, o_orderdate as first_ship_date, case o_orderstatus when 'F' then 60 when 'O' then 20 else 30 end as po_status_id,
 {_GROUP} as location_group_id from {{orders}} left join {{order_lines}} on l_orderkey = o_orderkey""",
    "fishbowl_poitem": """select o_orderkey as po_item_id, o_orderkey as purchase_order_id, part as part_id, qty as quantity_ordered,
 case when o_orderstatus = 'O' then qty / 2 else qty end as quantity_fulfilled, o_totalprice / 100 as unit_cost, o_totalprice as total_cost,
 o_orderdate as last_fulfillment_date, o_orderdate as scheduled_fulfillment_date, case when n > 4 then 2 else 1 end as uom_id,
 case when o_orderpriority = '3-MEDIUM' then 10 else 20 end as po_item_type_id, case when o_orderpriority = '2-HIGH' then 60 else 30 end as po_item_status_id
 from {orders} join {order_lines} on l_orderkey = o_orderkey""",
    "fishbowl_receipt": f"""select o_orderkey as receipt_id, case when o_orderpriority = '5-LOW' then 20 else 10 end as order_type_id,
 {_GROUP} as location_group_id from {{orders}}""",
    "fishbowl_receiptitem": f"""select item_id as receipt_item_id, l_orderkey as receipt_id, l_partkey as part_id, l_orderkey as po_item_id, {_UOM} as uom_id,
 l_quantity as quantity_received, case l_returnflag when 'A' then 10 when 'N' then 40 else 20 end as receipt_item_status_id,
 case when l_linestatus = 'O' and l_linenumber = 6 then null else l_shipdate end as received_at, l_shipdate as reconciled_at,
 l_shipdate as last_modified_at from {{items}}""",
    "fishbowl_wo": f"""select o_orderkey as work_order_id, case o_orderstatus when 'F' then 40 when 'O' then 10 else 30 end as status_id,
 {_GROUP} as location_group_id from {{orders}}""",
    "fishbowl_woitem": f"""select item_id as wo_item_id, l_orderkey as work_order_id, l_partkey as part_id, {_UOM} as uom_id,
 case l_returnflag when 'A' then 10 when 'N' then 20 else case when l_linestatus = 'O' then 30 else 31 end end as item_type_id,
 l_quantity as quantity_target from {{items}}""",
    "fishbowl_xo": f"""select o_orderkey as transfer_order_id, case o_orderstatus when 'F' then 60 when 'O' then 20 else 70 end as status_id,
 {_GROUP} as from_location_group_id, 6 - {_GROUP} as to_location_group_id from {{orders}}""",
    "fishbowl_xoitem": f"""select item_id as xo_item_id, l_orderkey as transfer_order_id, l_partkey as part_id, {_UOM} as uom_id,
 case when l_returnflag = 'A' then 10 else 20 end as item_type_id, case when l_linestatus = 'O' then 10 else 60 end as item_status_id,
 l_quantity + 1 as quantity_to_fulfill, l_linenumber * 1.0 as quantity_fulfilled from {{items}}""",
    # --- ERP stock ---
    "fishbowl_tag": """select item_id as tag_id, l_partkey as part_id, l_suppkey as location_id, item_id as tag_number,
 case l_returnflag when 'A' then 30 when 'N' then 40 else 10 end as tag_type_id, l_quantity as quantity_on_tag,
 l_linenumber * 1.0 as quantity_committed_on_tag from {items}""",
    "fishbowl_location": """select s_suppkey as location_id, s_nationkey as location_group_id, case when s_acctbal < 0 then 100 else 10 end as location_type_id,
 s_acctbal > 1000 as is_pickable, s_acctbal > 3000 as is_counted_as_available from {supplier}""",
    "fishbowl_tagserialview": """select item_id as tag_id, 'S' || cast(item_id as string) as serial_number_value from {items} where l_returnflag = 'N'
 union all select item_id, 'S' || cast(item_id as string) from {items} where l_returnflag = 'N' and l_linenumber = 1""",
    "fishbowl_serial": "select item_id as serial_id, item_id as tag_id, l_linestatus = 'F' as is_committed from {items}",
    "fishbowl_serialnum": """select item_id as serial_num_record_id, item_id as serial_number_id, l_linenumber as part_tracking_id,
 'S' || cast(item_id as string) as serial_number_value from {items}""",
    "fishbowl_parttracking": """select r_regionkey as part_tracking_id, r_name as part_tracking_name, substr(r_name, 1, 2) as part_tracking_abbreviation,
 'Track ' || r_name as part_tracking_description, r_regionkey as sort_order, 40 as part_tracking_type_id, r_regionkey > 1 as is_active from {region}""",
}
