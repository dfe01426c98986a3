"""DuckDB statements for the modelled tables, written independently of the Spark plans.

Names in braces refer to other statements or to the derived views; ``assemble`` turns
what a statement needs into a WITH clause.
"""

from __future__ import annotations

import string

from stocktally.config import RetailConfig
from workload.retail_views import BASE, VIEWS
from workload.tables import AS_OF, CFG, ITEM_ORDER


def _list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values)


def ny(ts: str) -> str:
    return f"(({ts}) at time zone 'UTC') at time zone '{CFG.timezone}'"


M: dict[str, str] = {}
_newest = ", ".join(f"{c} desc nulls last" for c in ITEM_ORDER)
M["items"] = f"""select * exclude (rk) from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {_newest}) as rk
 from {{item_log}}) where rk = 1"""
M["magento_d_customerupdated"] = f"""select customer_email, row_number() over (order by customer_email) as rank_id from (
 select distinct lower(case when customer_email is null or customer_email = '' then '{CFG.default_customer_email}' else customer_email end) as customer_email
 from {{magento_sales_order}})"""


# --- stock -------------------------------------------------------------------
def _lines(out: str, head: str, line: str, link: str, place: str, qty: str, keep: str, product: bool = False) -> str:
    part = "{fishbowl_product} pr on pr.product_id = l.product_id join {fishbowl_part} p on p.part_id = pr.part_id" if product \
        else "{fishbowl_part} p on p.part_id = l.part_id"
    return f"""select p.part_id, h.{place} as location_group_id, coalesce(sum(case when l.uom_id <> p.default_uom_id and u.uom_conversion_id is not null
 then ({qty}) * u.multiply_factor / nullif(u.factor, 0) else {qty} end), 0) as {out}
 from {{{line}}} l join {{{head}}} h on h.{link} = l.{link} join {part}
 left join {{fishbowl_uomconversion}} u on u.from_uom_id = l.uom_id and u.to_uom_id = p.default_uom_id where {keep} group by 1, 2"""


_so = dict(head="fishbowl_so", line="fishbowl_soitem", link="sales_order_id", place="location_group_id",
           qty="l.quantity_to_fulfill - l.quantity_fulfilled", product=True)
_wo = dict(head="fishbowl_wo", line="fishbowl_woitem", link="work_order_id", place="location_group_id", qty="l.quantity_target")
_xo = dict(head="fishbowl_xo", line="fishbowl_xoitem", link="transfer_order_id", qty="l.quantity_to_fulfill - l.quantity_fulfilled")
_xkeep = "h.status_id in (20, 30, 40, 50, 60) and l.item_status_id in (10, 20, 30, 40, 50) and l.item_type_id = "
M["inventory_qtyallocatedso"] = _lines("quantity_allocated_to_so", **_so, keep="h.status_id in (20, 25) and l.status_id in (10, 14, 20, 30, 40) and l.item_type_id in (10, 12)")
M["inventory_qtydropship"] = _lines("quantity_dropship", **_so, keep="h.status_id in (20, 25) and l.status_id in (10, 14, 20, 30, 40) and l.item_type_id = 12")
M["inventory_qtyonorderso"] = _lines("quantity_on_order_so", **_so, keep="h.status_id in (20, 25) and l.status_id in (10, 14, 30) and l.item_type_id = 20")
M["inventory_qtyallocatedpo"] = _lines("quantity_allocated_to_po", "fishbowl_po", "fishbowl_poitem", "purchase_order_id", "location_group_id",
    "l.quantity_ordered - l.quantity_fulfilled", "h.po_status_id >= 20 and h.po_status_id <= 55 and l.po_item_status_id in (10, 20, 30, 40, 45) and l.po_item_type_id in (20, 30)")
M["inventory_qtyonorderpo"] = _lines("quantity_on_order_po", "fishbowl_receipt", "fishbowl_receiptitem", "receipt_id", "location_group_id",
    "l.quantity_received", "h.order_type_id = 10 and l.receipt_item_status_id in (10, 20)")
M["inventory_qtyallocatedmo"] = _lines("quantity_allocated_to_mo", **_wo, keep="h.status_id < 40 and l.item_type_id in (20, 30)")
M["inventory_qtyonordermo"] = _lines("quantity_on_order_mo", **_wo, keep="h.status_id < 40 and l.item_type_id in (10, 31)")
M["inventory_qtyallocatedtosend"] = _lines("quantity_allocated_to_send", **_xo, place="from_location_group_id", keep=_xkeep + "10")
M["inventory_qtyallocatedtoreceive"] = _lines("quantity_allocated_to_receive", **_xo, place="to_location_group_id", keep=_xkeep + "20")
M["inventory_qtyonordertosend"] = _lines("quantity_on_order_to_send", **_xo, place="to_location_group_id", keep=_xkeep + "10")
M["inventory_qtyonordertoreceive"] = _lines("quantity_on_order_to_receive", **_xo, place="from_location_group_id", keep=_xkeep + "20")


def _tags(out: str, amount: str, keep: str) -> str:
    return f"""select t.part_id, l.location_group_id, coalesce(sum({amount}), 0) as {out} from {{fishbowl_tag}} t
 join {{fishbowl_location}} l on l.location_id = t.location_id where {keep} group by 1, 2"""


_free = "t.quantity_on_tag - t.quantity_committed_on_tag"
M["inventory_qtyonhand"] = _tags("quantity_on_hand", "t.quantity_on_tag", "t.tag_type_id in (30, 40)")
M["inventory_qtynotavailable"] = _tags("quantity_not_available", _free, "t.tag_type_id in (30, 40) and not l.is_counted_as_available and l.location_type_id <> 100")
M["inventory_qtynotavailabletopick"] = _tags("quantity_not_available_to_pick", _free, "t.tag_type_id in (30, 40) and not l.is_pickable and l.location_type_id <> 100")
M["inventory_qtycommitted"] = _tags("quantity_committed", "t.quantity_committed_on_tag", "true")


def _stacked(kinds: dict[str, str], out: str) -> str:
    body = " union all ".join(f"select part_id, location_group_id, {col} as q from {{{m}}}" for m, col in kinds.items())
    return f"select part_id, location_group_id, coalesce(sum(q), 0) as {out} from ({body}) group by 1, 2"


M["inventory_qtyallocated"] = _stacked({
    "inventory_qtyallocatedso": "quantity_allocated_to_so", "inventory_qtyallocatedpo": "quantity_allocated_to_po",
    "inventory_qtyallocatedtosend": "quantity_allocated_to_send", "inventory_qtyallocatedtoreceive": "quantity_allocated_to_receive",
    "inventory_qtyallocatedmo": "quantity_allocated_to_mo"}, "total_quantity_allocated")
M["inventory_qtyonorder"] = _stacked({
    "inventory_qtyonorderso": "quantity_on_order_so", "inventory_qtyonorderpo": "quantity_on_order_po",
    "inventory_qtyonordertosend": "quantity_on_order_to_send", "inventory_qtyonordertoreceive": "quantity_on_order_to_receive",
    "inventory_qtyonordermo": "quantity_on_order_mo"}, "total_quantity_on_order")

_WIDE = {  # output column: branch, its column
    "quantity_on_hand": [("inventory_qtyonhand", "quantity_on_hand")],
    "quantity_allocated_po": [("inventory_qtyallocatedpo", "quantity_allocated_to_po")],
    "quantity_allocated_so": [("inventory_qtyallocatedso", "quantity_allocated_to_so")],
    "quantity_allocated_mo": [("inventory_qtyallocatedmo", "quantity_allocated_to_mo")],
    "quantity_allocated_transfer_order": [("inventory_qtyallocatedtoreceive", "quantity_allocated_to_receive"), ("inventory_qtyallocatedtosend", "quantity_allocated_to_send")],
    "quantity_not_available": [("inventory_qtynotavailable", "quantity_not_available")],
    "quantity_not_available_to_pick": [("inventory_qtynotavailabletopick", "quantity_not_available_to_pick")],
    "quantity_dropship": [("inventory_qtydropship", "quantity_dropship")],
    "quantity_on_order_po": [("inventory_qtyonorderpo", "quantity_on_order_po")],
    "quantity_on_order_so": [("inventory_qtyonorderso", "quantity_on_order_so")],
    "quantity_on_order_transfer_order": [("inventory_qtyonordertoreceive", "quantity_on_order_to_receive"), ("inventory_qtyonordertosend", "quantity_on_order_to_send")],
    "quantity_on_order_mo": [("inventory_qtyonordermo", "quantity_on_order_mo")],
}
_branches = [(out, m, c) for out, pairs in _WIDE.items() for m, c in pairs]
M["inventory_qtyinventory"] = "select part_id, location_group_id, " + ", ".join(
    f"coalesce(sum(q) filter (k = '{out}'), 0) as {out}" for out in _WIDE
) + " from (" + " union all ".join(f"select part_id, location_group_id, {c} as q, '{out}' as k from {{{m}}}" for out, m, c in _branches) + ") group by 1, 2"
M["inventory_qtyinventorytotals"] = """select part_id, location_group_id, quantity_on_hand,
 quantity_allocated_po + quantity_allocated_so + quantity_allocated_transfer_order + quantity_allocated_mo as quantity_allocated,
 quantity_not_available, quantity_not_available_to_pick, quantity_dropship,
 quantity_on_order_po + quantity_on_order_so + quantity_on_order_transfer_order + quantity_on_order_mo as quantity_on_order from {inventory_qtyinventory}"""
M["inventory_qohview"] = """select l.location_group_id, t.location_id, t.part_id, t.tag_number, s.serial_number_value as serial_number,
 (1 - t.quantity_on_tag) * (count(s.serial_number_value) - 1) + 1 as calculated_quantity_on_hand
 from {fishbowl_tag} t join {fishbowl_location} l using (location_id) left join {fishbowl_tagserialview} s using (tag_id)
 where t.part_id is not null and t.tag_number is not null group by all, t.quantity_on_tag"""
M["inventory_qohview"] = M["inventory_qohview"].replace("group by all, t.quantity_on_tag", "group by 1, 2, 3, 4, 5, t.quantity_on_tag")
M["inventory_tagserialviewview"] = """select n.part_tracking_id, s.serial_id, k.part_tracking_name, k.part_tracking_abbreviation, k.part_tracking_description,
 k.sort_order as part_tracking_sort_order, k.part_tracking_type_id, s.tag_id, n.serial_num_record_id, n.serial_number_value, s.is_committed,
 k.is_active as is_part_tracking_active from {fishbowl_serialnum} n join {fishbowl_serial} s on s.serial_id = n.serial_number_id
 join {fishbowl_parttracking} k on k.part_tracking_id = n.part_tracking_id"""
M["f_inventoryview"] = f"""select part_number, sum(on_hand) as qty_available, sum(held) as qty_not_available, sum(coming) as qty_on_order, max(unit) as part_cost,
 sum(on_hand) * max(unit) as extended_cost from (
 select p.part_number, coalesce(i.quantity_on_hand, 0) as on_hand, coalesce(i.quantity_not_available, 0) as held,
  coalesce(i.quantity_on_order, 0) as coming, coalesce(c.average_cost, 0) as unit
 from {{inventory_qtyinventorytotals}} i left join {{fishbowl_part}} p using (part_id) left join {{fishbowl_partcost}} c using (part_id)
 where i.location_group_id = {CFG.default_location_group_id}) group by part_number"""

# --- products ----------------------------------------------------------------
_codes = _list(("name", "suggested_use", "url_key", "image", "caliber", "manufacturer_sku", "optic_coating", "price", "status"))
M["int_magento_product_attributes"] = "select entity_id, " + ", ".join(
    f"max(value) filter (attribute_code = '{code}') as {out}" for code, out in CFG.text_attributes
) + f""" from (select entity_id, attribute_id, value from {{magento_catalog_product_entity_varchar}} where store_id = 0
 union all select entity_id, attribute_id, value from {{magento_catalog_product_entity_text}} where store_id = 0
 union all select entity_id, attribute_id, cast(value as varchar) from {{magento_catalog_product_entity_decimal}} where store_id = 0) v
 join {{magento_eav_attribute}} a using (attribute_id) where attribute_code in ({_codes}) group by entity_id"""


def _opt(attr: int) -> str:
    return f"""(select max(o.value) from {{magento_catalog_product_entity_int}} x join {{magento_eav_attribute_option_value}} o on o.option_id = x.value
 where x.entity_id = e.product_entity_id and x.store_id = 0 and o.store_id = 0 and x.attribute_id = {attr})"""


def _txt(attr: int) -> str:
    return f"""(select max(x.value) from {{magento_catalog_product_entity_varchar}} x where x.entity_id = e.product_entity_id and x.store_id = 0 and x.attribute_id = {attr})"""


_o, _v = {n: a for a, n in CFG.option_attributes}, {n: a for a, n in CFG.varchar_attributes}
M["int_magento_product_eav_lookups"] = "select e.product_entity_id as entity_id, " + ", ".join(
    [f"{_opt(_o[n])} as {n}" for n in ("manufacturer", "projectile", "unit_type")] + [f"{_txt(a)} as {n}" for n, a in _v.items()]
    + [f"{_opt(_o[n])} as {n}" for n in ("primary_category", "ddcaliber", "ddaction", "ddcondition", "ddgun_parts", "ddcolor")]
    + ["""(select max(x.value) from {magento_catalog_product_entity_text} x join {magento_eav_attribute} a using (attribute_id)
 where x.entity_id = e.product_entity_id and a.attribute_code = 'optic_coating' and x.store_id = 0) as optic_coating""",
       f"{_opt(_o['ddweapons_platform'])} as ddweapons_platform",
       f"""(select string_agg(o.value, ', ' order by o.value) from (select x.entity_id, try_cast(trim(unnest(string_split(x.value, ','))) as bigint) as option_id
 from {{magento_catalog_product_entity_text}} x where x.attribute_id = {CFG.suggested_use_attribute_id} and x.store_id = 0) q
 join {{magento_eav_attribute_option_value}} o on o.option_id = q.option_id where q.entity_id = e.product_entity_id and o.store_id = 0) as dd_suggested_use"""]
) + " from {magento_catalog_product_entity} e"
M["int_magento_product_taxonomy"] = """select e.product_entity_id as entity_id, c.categories, s.parent_sku from {magento_catalog_product_entity} e
 left join (select l.product_id, string_agg(v.value, ' > ' order by v.value) as categories from {magento_catalog_category_product} l
  join {magento_catalog_category_entity_varchar} v on v.entity_id = l.category_id
  where v.attribute_id in (select attribute_id from {magento_eav_attribute} where attribute_code = 'name') group by 1) c on c.product_id = e.product_entity_id
 left join (select l.product_id, arg_max(p.sku, l.parent_id) as parent_sku from {magento_catalog_product_super_link} l
  join {magento_catalog_product_entity} p on p.product_entity_id = l.parent_id group by 1) s on s.product_id = e.product_entity_id"""
M["product_factors"] = """select p.product_number, avg(u.multiply_factor) as factor, avg(c.average_cost) as avgcost, avg(v.lastcost) as lastcost from {fishbowl_product} p
 left join {fishbowl_uomconversion} u on u.from_uom_id = p.uom_id and u.to_uom_id = 1 left join {fishbowl_partcost} c using (part_id)
 left join (select partid, arg_max(lastcost, (datelastmodified, id)) as lastcost from {fishbowl_vendor_parts} group by 1) v on v.partid = p.part_id group by 1"""
M["int_fishbowl_product_enrichment"] = f"""select e.product_entity_id as entity_id, e.sku, v.vendor,
 case when e.attribute_set_id = {CFG.discontinued_attribute_set_id} then 'Yes' else 'No' end as discontinued, s.attribute_set_name,
 coalesce(f.factor, 1) as convert, f.avgcost, f.lastcost as lastvendorcost from {{magento_catalog_product_entity}} e
 left join (select x.entity_id, max(o.value) as vendor from {{magento_catalog_product_entity_int}} x
  join {{magento_eav_attribute_option_value}} o on o.option_id = x.value where x.attribute_id = {CFG.vendor_attribute_id} group by 1) v on v.entity_id = e.product_entity_id
 left join {{magento_eav_attribute_set}} s on s.attribute_set_id = e.attribute_set_id left join {{product_factors}} f on f.product_number = e.sku"""


def _use_type(cfg: RetailConfig) -> str:
    def has(col: str, *words: str) -> str:
        return "(" + " or ".join(f"{col} ilike '%{w}%'" for w in words) + ")"

    def p(values) -> str:
        return f"projectile in ({_list(values)})"

    def c(values) -> str:
        return f"dd_caliber in ({_list(values)})"

    n, g, u = "product_name", "categories", "general_purpose"
    return f"""case when {has(g, 'hunting')} or {has(u, 'hunting')} or {has(n, 'hunting')} or {p(cfg.hunting_projectiles)}
  or ({c(cfg.hunting_calibers)} and not {p(cfg.non_hunting_projectiles)}) then 'Hunting'
 when {has(g, 'defense')} or {has(u, 'defense')} or {has(n, 'defense', 'personal')} or {p(cfg.defense_projectiles)}
  or ({c(cfg.defense_calibers)} and (projectile = 'HP' or {has(n, 'carry')})) or projectile like '%Buck%' then 'Self-Defense/Personal Protection'
 when {has(g, 'tactical', 'law enforcement')} or {has(u, 'tactical')} or {has(n, 'tactical', 'duty', 'law enforcement')}
  or projectile = 'SS109/Green Tip' or ({c(cfg.tactical_calibers)} and {p(cfg.tactical_projectiles)}) then 'Tactical/Law Enforcement'
 when {has(g, 'sport', 'target', 'competition')} or {has(u, 'sport')} or {has(n, 'target', 'competition', 'match', 'practice', 'range')}
  or ({p(cfg.sporting_projectiles)} and not {has(n, 'defense', 'tactical')}) or {p(cfg.sporting_shot_types)} or dd_caliber = '22 LR' then 'Sporting/Target'
 when {has(g, 'collector')} or {has(n, 'collector', 'limited', 'special edition')} then 'Collector/Specialty'
 when {c(cfg.sporting_fallback_calibers)} then 'Sporting/Target' when {c(cfg.hunting_fallback_calibers)} then 'Hunting'
 when {c(cfg.defense_fallback_calibers)} then 'Self-Defense/Personal Protection' when {c(cfg.tactical_fallback_calibers)} then 'Tactical/Law Enforcement'
 when {c(cfg.shotgun_gauges)} then case when {p(cfg.shotgun_sporting_shot)} then 'Sporting/Target'
  when {p(cfg.shotgun_defense_shot)} then 'Self-Defense/Personal Protection' else 'Sporting/Target' end
 when {p(('FMJ', 'TMJ', 'Ball', 'LRN', 'LFN'))} then 'Sporting/Target' when {p(('JHP', 'HP', 'XTP'))} then 'Self-Defense/Personal Protection'
 when {p(('SP', 'JSP', 'BTSP'))} then 'Hunting' else 'Unclassified' end"""


M["d_product"] = f"""select *, {_use_type(CFG)} as use_type_category from (
 select b.entity_id as product_id, b.sku, a.product_name, a.general_purpose, '{CFG.base_url}/' || a.url_key as product_url,
 '{CFG.base_url}/media/catalog/product' || a.image as product_image_url, b.vendor, b.discontinued, x.parent_sku,
 coalesce(x.parent_sku, b.sku) as grouped_sku, a.boxes_case, a.upc, o.rounds_package, x.categories, o.optic_coating,
 o.ddweapons_platform as dd_weapons_platform, a.thread_pattern, a.thread_type, a.model, b.convert, b.avgcost, b.lastvendorcost, o.dd_suggested_use,
 trim(a.caliber) as caliber, trim(a.manufacturer_sku) as manufacturer_sku, trim(o.manufacturer) as manufacturer, trim(o.projectile) as projectile,
 trim(o.unit_type) as unit_type, trim(b.attribute_set_name) as attribute_set, trim(a.gun_type) as gun_type, trim(o.ddcaliber) as dd_caliber,
 trim(o.ddaction) as dd_gun_action, trim(o.ddcondition) as dd_condition, trim(o.ddgun_parts) as dd_gun_parts, trim(o.capacity) as capacity,
 trim(o.material) as material, trim(o.primary_category) as primary_category, trim(o.ddcolor) as dd_color
 from {{int_fishbowl_product_enrichment}} b left join {{int_magento_product_attributes}} a using (entity_id)
 left join {{int_magento_product_eav_lookups}} o using (entity_id) left join {{int_magento_product_taxonomy}} x using (entity_id))"""
M["int_product_analyst"] = """select product_id, sku, product_name, caliber, manufacturer_sku as manufacturer, projectile, vendor as product_vendor, use_type_category,
 primary_category, discontinued, unit_type, avgcost, lastvendorcost, general_purpose from {d_product}"""
M["d_product_bundle"] = """select k.component_product_id, k.kit_product_id, c.product_number as individual_num, k.default_quantity, b.product_number as num_bundle,
 coalesce(f.factor, 1) * k.default_quantity as conversion_rate, 'KIT' as kit_type from {fishbowl_kititem} k
 left join {fishbowl_product} c on c.product_id = k.component_product_id left join {fishbowl_product} b on b.product_id = k.kit_product_id
 left join {product_factors} f on f.product_number = c.product_number
 where k.kit_type_id = 10 and c.product_number not like '%POLLYAMOBAG%' and c.product_number not like '%POLYAMMOBAG%'"""

# --- cost and freight ----------------------------------------------------------
M["int_fishbowl_magento_order_map"] = """select f.sales_order_id as fishbowl_so_id, m.order_id as magento_order_id from {fishbowl_so} f
 join {magento_sales_order} m on m.order_increment_id = split_part(f.sales_order_number, '-', 1)"""
M["erp_costs"] = """with priced as (select s.*, coalesce(c.average_cost * u.multiply_factor, c.average_cost) as unit_weighted from {fishbowl_soitem} s
  left join {fishbowl_product} p on p.product_id = s.product_id left join {fishbowl_partcost} c on c.part_id = p.part_id
  left join {fishbowl_uomconversion} u on u.from_uom_id = p.uom_id and u.to_uom_id = 1),
 kit as (select k.object2_record_id as so_item_id, coalesce(nullif(sum(s.total_cost), 0), sum(s.quantity_ordered * s.unit_weighted)) as kit_cost,
  sum(s.unit_weighted) as kit_weighted from priced s join {fishbowl_objecttoobject} k on k.object1_record_id = s.so_item_id and k.relationship_type_id = 30
  where s.item_type_id = 10 and s.product_description not ilike '%POLLYAMOBAG%' group by 1)
 select coalesce(nullif(case when json_valid(s.custom_fields) then json_extract_string(s.custom_fields, '$.25.value') end, ''), g.channel_id) as item_ref,
  q.channel_id as product_ref, case when s.total_cost = 0 then kit.kit_cost else s.total_cost end as cost,
  coalesce(kit.kit_weighted, s.unit_weighted) as weighted from priced s
 left join {fishbowl_plugininfo} g on g.record_id = s.so_item_id and g.related_table_name = 'SOItem'
 left join {fishbowl_plugininfo} q on q.record_id = s.product_id and q.related_table_name = 'Product' left join kit on kit.so_item_id = s.so_item_id"""
M["int_fishbowl_order_cost"] = """with hits as (select *, count(*) over (partition by item_ref) as hits from {erp_costs} where item_ref is not null),
 multi as (select item_ref, product_ref, avg(cost) as cost, avg(weighted) as weighted from hits where hits > 1 group by 1, 2),
 spread as (select m.item_ref, avg(m.cost) as cost, avg(m.weighted) as weighted from multi m
  join {magento_sales_order_item} i on cast(i.order_item_id as varchar) = m.item_ref where i.row_total <> 0 group by 1),
 flat as (select i.order_item_id, i.order_id, i.product_id as magento_product_id, a.cost as cost_unique, a.weighted as averageweightedcost_unique,
  b.cost as cost_duplicate, b.weighted as averageweightedcost_duplicate, c.cost as cost_avg, c.weighted as averageweightedcost_avg
  from {magento_sales_order_item} i left join hits a on a.hits = 1 and a.item_ref = cast(i.order_item_id as varchar)
  left join multi b on b.item_ref = cast(i.order_item_id as varchar) and b.product_ref = cast(i.product_id as varchar)
  left join spread c on c.item_ref = cast(i.order_item_id as varchar))
 select *, sum(coalesce(cost_unique, cost_duplicate)) over (partition by order_id) as order_cost,
  sum(coalesce(averageweightedcost_unique, averageweightedcost_duplicate)) over (partition by order_id) as order_cost_average from flat"""
_COST = """coalesce(c.cost_unique, c.cost_duplicate, c.cost_avg, c.averageweightedcost_unique * z.quantity_ordered,
 c.averageweightedcost_duplicate * z.quantity_ordered, c.averageweightedcost_avg * z.quantity_ordered)"""
_NET = "z.row_total - coalesce(z.amount_refunded, 0) - coalesce(z.discount_amount, 0) + coalesce(z.discount_refunded, 0)"
M["int_sales_cost_fallback"] = f"""with base as (select z.order_item_id, z.product_id, z.product_type, z.parent_item_id, z.item_created_at as sold,
  case when {_NET} = 0 then 0 else z.quantity_ordered end as qty, case when z.quantity_ordered > 0 then {_COST} end as cost
  from {{magento_sales_order_item}} z left join {{int_fishbowl_order_cost}} c using (order_item_id)),
 full_rows as (select b.product_id, b.sold, case when p.order_item_id is null then b.cost else p.cost end as cost,
  case when p.order_item_id is null then b.qty else p.qty end as qty from base b
  left join base p on p.order_item_id = b.parent_item_id and p.product_type = 'configurable'),
 good as (select *, max(sold) over (partition by product_id) as newest from full_rows where cost > 0 and qty > 0)
 select product_id, sum(cost) / nullif(sum(qty), 0) as fallback_unit_cost from good where sold = newest group by 1"""
M["invoiced"] = "select tracking_number, sum(net_amount) as net_amount from {magento_ups_invoice} group by 1"
M["int_magento_order_freight"] = f"""with per_so as (select s.sales_order_id, coalesce(sum(i.net_amount), sum(c.freight_amount)) as amount from {{fishbowl_ship}} s
  left join {{fishbowl_shipcarton}} c using (shipment_id) left join {{invoiced}} i using (tracking_number) group by 1),
 per_order as (select m.magento_order_id as order_id, avg(p.amount) as amount from {{int_fishbowl_magento_order_map}} m
  left join per_so p on p.sales_order_id = m.fishbowl_so_id group by 1),
 heavy as (select z.order_id, sum(z.item_weight) as total_weight, count(z.product_id) as product_count from {{magento_sales_order_item}} z
  join {{magento_catalog_product_entity}} e on e.product_entity_id = z.product_id
  where {_NET} <> 0 and z.quantity_ordered <> 0 and e.sku not ilike '%parceldefender%' group by 1)
 select o.order_id, o.shipping_amount, o.base_shipping_amount, o.base_shipping_canceled, o.base_shipping_discount_amount, o.base_shipping_refunded,
  o.base_shipping_tax_amount, o.base_shipping_tax_refunded, coalesce(o.base_shipping_amount, 0) - coalesce(o.base_shipping_tax_amount, 0)
  - coalesce(o.base_shipping_refunded, 0) + coalesce(o.base_shipping_tax_refunded, 0) as net_sales, p.amount as freight_amount, h.total_weight, h.product_count
 from {{magento_sales_order}} o left join per_order p using (order_id) left join heavy h using (order_id)"""


def _pieces(key: str) -> str:
    return f"""select z.order_item_id as item_id, e.sku, sum(z.quantity_ordered * coalesce(u.multiply_factor, 1)) as part_qty_sold,
 avg(coalesce(u.multiply_factor, 1)) as conversion from {{magento_sales_order_item}} z join {{magento_sales_order}} o on o.order_id = z.order_id
 join {{magento_catalog_product_entity}} e on e.product_entity_id = z.product_id join {{fishbowl_product}} p on p.product_number = e.sku
 join {{fishbowl_part}} q on q.part_id = p.part_id left join {{fishbowl_uomconversion}} u on u.from_uom_id = {key} and u.to_uom_id = 1
 where z.product_type <> 'bundle' and z.row_total <> 0 group by 1, 2"""


M["int_magento_product_conversion"] = _pieces("p.uom_id")
M["pieces_by_shop_id"] = _pieces("z.product_id")

# --- sales ---------------------------------------------------------------------
_RANK = f"""left join {{magento_d_customerupdated}} k on k.customer_email = lower(case when coalesce(%s, '') = '' then '{CFG.default_customer_email}' else %s end)"""


def shop_sales_sql(scope: str = "true") -> str:
    """Shop branch of the sales table over the orders that meet a condition."""
    return f"""with z as (select * from {{magento_sales_order_item}} where {scope} and order_id not in (
  select order_id from {{magento_sales_order_item}} where sku in ({_list(CFG.excluded_order_skus)}))),
 a as (select z.order_item_id, z.order_id, z.product_id, z.parent_item_id, z.product_type, z.product_options, z.sku, z.vendor_id, z.store_id, z.base_cost,
  z.item_weight as w, {ny('z.item_created_at')} as sold, {_NET} as net, case when z.row_total <> 0 then z.quantity_ordered else 0 end as q0,
  {_COST} as c0, f.net_sales, coalesce(f.freight_amount, f.net_sales) as freight_base, f.total_weight, f.product_count, t.part_qty_sold, coalesce(t.conversion, 1) as conversion
  from z left join {{int_fishbowl_order_cost}} c on c.order_item_id = z.order_item_id left join {{int_magento_order_freight}} f on f.order_id = z.order_id
  left join {{int_magento_product_conversion}} t on t.item_id = z.order_item_id),
 b as (select *, case when net = 0 then 0 else q0 end as qty, case when q0 > 0 then c0 end as cost from a),
 d as (select *, case when total_weight is null and sku not ilike '%parceldefender%' then qty * net_sales / nullif(product_count * qty, 0)
   else w * qty * net_sales / nullif(total_weight * qty, 0) end as fr,
  case when total_weight is null and sku not ilike '%parceldefender%' then qty / nullif(product_count * qty, 0) * freight_base
   else w * qty / nullif(total_weight * qty, 0) * freight_base end as fc from b)
 select cast(i.sold as date) as created_at, i.sold as timedate, i.order_item_id as id, o.order_increment_id as increment_id, date_trunc('hour', i.sold) as hour_start,
  i.product_id, i.order_id, i.sold as trickat, i.product_options, i.product_type, i.parent_item_id, i.sku as testsku, i.conversion,
  strftime(date_trunc('hour', i.sold), '%H:%M:%S') as hour_text, o.customer_email, g.postcode, g.country_code as country, g.region, g.city,
  g.street_address as street, g.phone_number as telephone, o.customer_firstname || ' ' || o.customer_lastname as customer_name, i.store_id,
  case when o.order_increment_id like 'GB%' then 'GunBroker' else 'Website' end as storefront, upper(o.order_status) as status,
  case when p.order_item_id is null then i.net else p.net end as row_total,
  coalesce(case when p.order_item_id is null then i.cost else p.cost end,
   h.fallback_unit_cost * case when p.order_item_id is null then i.qty else p.qty end, i.base_cost) as cost,
  case when p.order_item_id is null then i.qty else p.qty end as qty_ordered, case when p.order_item_id is null then i.fr else p.fr end as freight_revenue,
  case when p.order_item_id is null then i.fc else p.fc end as freight_cost, i.vendor_id as vendor, o.customer_id, k.rank_id,
  coalesce(case when p.order_item_id is null then i.part_qty_sold else p.part_qty_sold end, case when p.order_item_id is null then i.qty else p.qty end) as part_qty_sold,
  p.cost as testc, p.net as testr, p.fr as testfr, p.fc as testfc
 from d i left join d p on p.product_type = 'configurable' and p.order_item_id = i.parent_item_id
 left join {{magento_sales_order}} o on o.order_id = i.order_id left join {{magento_sales_order_address}} g on g.order_address_id = o.billing_address_id
 left join {{int_sales_cost_fallback}} h on h.product_id = i.product_id {_RANK % ('o.customer_email', 'o.customer_email')}
 where i.product_type <> 'configurable'"""


M["shop_sales"] = shop_sales_sql()
M["int_fishbowl_gunbroker_sales"] = f"""with x as (select i.*, o.sales_order_number, o.status_id as order_status, o.customer_email, o.customer_phone, o.bill_to_name,
  o.bill_to_address, o.bill_to_city, o.bill_to_zip, {ny('o.created_at')} as sold from {{fishbowl_soitem}} i join {{fishbowl_so}} o using (sales_order_id)
  where i.item_type_id = 10 and o.sales_order_number like 'GB%'),
 ship as (select s.sales_order_id, coalesce(sum(v.net_amount), sum(c.freight_amount)) as amount from {{fishbowl_ship}} s left join {{fishbowl_shipcarton}} c using (shipment_id)
  left join {{invoiced}} v using (tracking_number) group by 1),
 y as (select x.*, sum(total_price) over (partition by sales_order_id) as revenue, count(*) over (partition by sales_order_id) as n from x)
 select cast(y.sold as date) as created_at, y.sold as timedate, -y.so_item_id as id, y.sales_order_number as increment_id, date_trunc('hour', y.sold) as hour_start,
  coalesce(cast(m.channel_id as bigint), -y.product_id) as product_id, -y.sales_order_id as order_id, y.sold as trickat, cast(null as varchar) as product_options,
  'simple' as product_type, cast(null as bigint) as parent_item_id, y.product_number as testsku, coalesce(u.multiply_factor, 1) as conversion,
  strftime(date_trunc('hour', y.sold), '%H:%M:%S') as hour_text, y.customer_email, y.bill_to_zip as postcode, 'US' as country, cast(null as varchar) as region,
  y.bill_to_city as city, y.bill_to_address as street, y.customer_phone as telephone, y.bill_to_name as customer_name, cast(null as int) as store_id,
  'GunBroker' as storefront, case when y.order_status in (20, 25) then 'PROCESSING' when y.order_status in (30, 40, 60) then 'COMPLETE'
   when y.order_status = 50 then 'CANCELED' else 'ESTIMATE' end as status, y.total_price as row_total, y.total_cost as cost, y.quantity_ordered as qty_ordered,
  cast(null as double) as freight_revenue, case when y.revenue > 0 then s.amount * y.total_price / y.revenue else s.amount / y.n end as freight_cost,
  cast(null as bigint) as vendor, cast(null as bigint) as customer_id, k.rank_id, y.quantity_ordered * coalesce(u.multiply_factor, 1) as part_qty_sold,
  cast(null as double) as testc, cast(null as double) as testr, cast(null as double) as testfr, cast(null as double) as testfc
 from y left join ship s using (sales_order_id) left join {{fishbowl_plugininfo}} m on m.record_id = y.product_id and m.related_table_name = 'Product'
 left join {{fishbowl_product}} p on p.product_id = y.product_id left join {{fishbowl_uomconversion}} u on u.from_uom_id = p.uom_id and u.to_uom_id = 1
 {_RANK % ('y.customer_email', 'y.customer_email')}"""
M["f_sales"] = "select * from {shop_sales} union all by name select * from {int_fishbowl_gunbroker_sales}"
M["active_sales"] = f"select * from {{f_sales}} where status in ({_list(CFG.valid_order_statuses)})"
M["int_daily_sales_metrics"] = """select created_at as sale_date, sum(row_total) as daily_revenue, count(distinct order_id) as daily_orders,
 round((sum(row_total) - sum(cost)) / nullif(sum(row_total), 0) * 100, 2) as daily_margin_pct from {active_sales} group by 1 having sum(row_total) > 0"""
M["v_daily_revenue"] = "select created_at as sale_date, sum(row_total) as total_revenue from {active_sales} group by 1"
M["int_daily_sales_by_caliber"] = f"""select sale_date, caliber, units_sold from (select *, count(*) over (partition by caliber) as days from (
 select s.created_at as sale_date, p.caliber, sum(s.qty_ordered) as units_sold from {{active_sales}} s join {{d_product}} p using (product_id)
 where p.caliber <> '' group by 1, 2)) where days >= {CFG.min_series_days}"""
M["f_sales_realtime"] = f"""select s.*, order_id as id_rfv, cost as base_cost,
 (select count(distinct x.order_id) from {{f_sales}} x where x.created_at = s.created_at) as distinct_order_id_count,
 (select count(distinct x.order_id) from {{f_sales}} x where x.created_at = s.created_at and x.testsku = s.testsku) as distinct_order_id_by_testsku
 from {{f_sales}} s where s.created_at >= date '{AS_OF}' - {CFG.realtime_days}"""

# --- purchasing and shipping -----------------------------------------------------
M["f_pos"] = f"""with r as (select i.*, h.location_group_id, lag(i.received_at) over (partition by i.po_item_id order by i.received_at nulls last, i.receipt_item_id) as prior
  from {{fishbowl_receiptitem}} i join {{fishbowl_receipt}} h using (receipt_id) where h.order_type_id = 10 and i.receipt_item_status_id in (10, 40)),
 b as (select p.part_id, r.receipt_item_id, r.location_group_id, coalesce(case when r.uom_id <> p.default_uom_id and u.uom_conversion_id is not null
   then r.quantity_received * u.multiply_factor / (case u.factor when 0 then 1 else u.factor end) else r.quantity_received end, 0) as qty,
  r.reconciled_at as datereconciled, p.part_number, r.received_at as datereceived, r.last_modified_at as datelastmodified, x.unit_cost, x.total_cost,
  x.last_fulfillment_date, x.scheduled_fulfillment_date, x.quantity_fulfilled, x.quantity_ordered as quantity_to_fulfill, o.vendor_id, o.created_at as po_created_at,
  o.confirmed_at as po_confirmed_at, o.issued_at as po_issued_at, o.first_ship_date as po_first_shipment_date, x.purchase_order_id, r.receipt_item_status_id,
  r.po_item_id, coalesce(r.prior, o.created_at) as last_date_prior_to_received
  from r left join {{fishbowl_poitem}} x using (po_item_id) left join {{fishbowl_po}} o using (purchase_order_id) left join {{fishbowl_part}} p on p.part_id = r.part_id
  left join {{fishbowl_uomconversion}} u on u.to_uom_id = p.default_uom_id and u.from_uom_id = r.uom_id),
 k as (select *, datediff('day', last_date_prior_to_received, datereceived) as lead,
  row_number() over (partition by vendor_id, part_number order by datereceived desc, receipt_item_id desc) as r1,
  row_number() over (partition by vendor_id order by datereceived desc, receipt_item_id desc) as r2,
  row_number() over (partition by part_number order by datereceived desc, receipt_item_id desc) as r3
  from b where datereceived is not null and last_date_prior_to_received is not null),
 l1 as (select vendor_id, part_number, ceil(avg(lead)) as v from k where r1 <= 3 group by 1, 2), l2 as (select vendor_id, ceil(avg(lead)) as v from k where r2 <= 3 group by 1),
 l3 as (select part_number, ceil(avg(lead)) as v from k where r3 <= 3 group by 1)
 select b.*, l2.v as vendor_lead_time, l1.v as vendor_product_leadtime, l3.v as product_leadtime, coalesce(l1.v, l2.v, l3.v) as precise_leadtime,
  b.last_date_prior_to_received + to_days(cast(coalesce(l1.v, l2.v, l3.v) as int)) as date_expected
 from b left join l1 using (vendor_id, part_number) left join l2 using (vendor_id) left join l3 using (part_number)"""


def _shipments(carrier_key: str) -> str:
    return f"""with per_ship as (select s.shipment_id, s.sales_order_id, coalesce(sum(i.net_amount), sum(c.freight_weight)) as amount, sum(c.freight_weight) as weight,
  avg(s.carrier_service_id) as carrier, sum(i.net_amount) as net, count(c.tracking_number) as packages from {{fishbowl_ship}} s
  left join {{fishbowl_shipcarton}} c using (shipment_id) left join {{invoiced}} i using (tracking_number) group by 1, 2),
 per_order as (select m.magento_order_id as order_id, avg(amount) as freightamount, avg(weight) as freightweight, avg(carrier) as carrierserviceid,
  avg(net) as net_amount, avg(packages) as packagenumb from {{int_fishbowl_magento_order_map}} m left join per_ship p on p.sales_order_id = m.fishbowl_so_id group by 1)
 select coalesce(o.shipping_amount, 0) as shipping_amount, coalesce(o.base_shipping_amount, 0) as base_shipping_amount,
  coalesce(o.base_shipping_canceled, 0) as base_shipping_canceled, coalesce(o.base_shipping_discount_amount, 0) as base_shipping_discount_amount,
  coalesce(o.base_shipping_refunded, 0) as base_shipping_refunded, coalesce(o.base_shipping_tax_amount, 0) as base_shipping_tax_amount,
  coalesce(o.base_shipping_tax_refunded, 0) as base_shipping_tax_refunded, o.order_increment_id as id, o.order_id, o.customer_email, {ny('o.created_at')} as created_at,
  o.customer_firstname || ' ' || o.customer_lastname as customer_name, o.shipping_address_id as billing_address, o.shipping_method as shipping_information,
  o.store_id, o.shipping_description, g.shipment_status_code as shipment_status, g.shipping_address_text as shipping_address, g.shipping_name,
  o.order_status as status, g.shipping_information as shipping_information2, r.method, r.carrier_title, a.postcode, a.country_code as country, a.region, a.city,
  a.phone_number as telephone, p.freightamount, p.net_amount, p.packagenumb, p.freightweight, q.ext_shipping_info,
  case when o.base_subtotal >= {CFG.free_shipping_threshold} then 'Yes' else 'No' end as isfree, p.carrierserviceid,
  case when o.quote_id in (select d.quote_id from {{magento_quote_address}} d join {{magento_quote_shipping_rate}} y using (quote_address_id)
   where y.method_title ilike '%free%') then 'Yes' else 'No' end as isfreeauto, v.carrier_id as idcarrier, v.carrier_service_name as carrierservice
 from {{magento_sales_order}} o left join {{magento_sales_shipment_grid}} g using (order_id)
 left join (select quote_shipping_rate_code as code, max(method) as method, max(carrier_title) as carrier_title from {{magento_quote_shipping_rate}} group by 1) r on r.code = o.shipping_method
 left join {{magento_sales_order_address}} a on a.address_type = 'shipping' and a.order_address_id = o.shipping_address_id
 left join per_order p using (order_id) left join {{magento_quote}} q on q.entity_id = o.quote_id
 left join {{fishbowl_carrierservice}} v on v.{carrier_key} = round(p.carrierserviceid)"""


M["f_shippment"] = _shipments("carrier_service_id")
M["f_shippment_by_carrier"] = _shipments("carrier_id")

# --- customers -------------------------------------------------------------------
M["int_customer_cohort"] = "select rank_id, min(date_trunc('month', created_at))::date as cohort_month from {f_sales} group by 1"
_COHORT = """count(distinct rank_id) as purchasers, count(distinct case when month_number = 0 then rank_id end) as cohort_size"""
M["f_cohort"] = f"""select cohort_month, month_number, {_COHORT} from (select s.rank_id, c.cohort_month, datediff('month', c.cohort_month, s.created_at) as month_number
 from {{f_sales}} s join {{int_customer_cohort}} c using (rank_id)) group by 1, 2"""
M["f_cohort_detailed"] = f"""select cohort_month, month_number, manufacturer_sku, region, store_id, {_COHORT} from (select s.rank_id, c.cohort_month, p.manufacturer_sku,
 s.region, s.store_id, datediff('month', c.cohort_month, s.created_at) as month_number from {{f_sales}} s join {{int_customer_cohort}} c using (rank_id)
 join {{d_product}} p using (product_id)) group by all"""


def segmentation_sql(email: str = "customer_email", account: str = "email") -> str:
    start, end = f"date_trunc('month', date '{AS_OF}') - interval 1 year", f"date_trunc('month', date '{AS_OF}')"
    def steps(col, cuts, names, last):
        return "case " + " ".join(f"when {col} {op} {u} then {n}" for (op, u), n in zip(cuts, names)) + f" else {last} end"
    f, rl, rs, v, m = CFG.frequency_bands, CFG.recency_label_bands, CFG.recency_score_bands, CFG.value_bands, CFG.margin_bands
    freq = steps("n", [("=", 1), ("<=", f[0]), ("<=", f[1]), ("<=", f[2]), (">=", f[2])], (1, 2, 3, 4, 5), 0)
    label = steps("days", [("<=", u) for u in rl], (5, 4, 3, 2, 1), 0)
    score = steps("days", [("<=", u) for u in rs], (5, 4, 3, 2, 1), 0)
    value = steps("rev", [("<", v[0]), ("<=", v[1]), ("<=", v[2]), ("<=", v[3]), (">", v[3])], (1, 2, 3, 4, 5), 0)
    margin = steps("mg", [("<", u) for u in m] + [(">=", m[3])], (1, 2, 3, 4, 5), 0)
    return f"""with yearly as (select {email} as e, count(distinct order_id) as n, sum(row_total) as rev,
  case when sum(row_total) = 0 then null else (sum(row_total) - sum(cost)) / sum(row_total) end as mg,
  datediff('day', max(created_at), cast({end} as date) - 1) as days from {{active_sales}} where created_at >= {start} and created_at < {end} group by 1),
 ever as (select {email} as e, count(distinct order_id) as total from {{active_sales}} group by 1),
 s as (select c.customer_email, c.rank_id, n, rev, mg, days, total, {freq} as f, {label} as r, {score} as rs, {value} as v, {margin} as m
  from {{magento_d_customerupdated}} c left join yearly y on y.e = c.customer_email left join ever x on x.e = c.customer_email)
 select s.customer_email, rank_id, n as number_of_purchases, rev as total_revenue, mg as margin, days as days_since_last_purchase, total as total_purchases_all_time,
  'F' || f as frequency, f as frequency_int, 'R' || r as recency, rs as recency_int, 'V' || v as value, v as value_int, 'M' || m as margin_classification,
  m as margin_int, 'MV' || cast((m + v) // 2 as int) as monetary_value,
  case f * 10 + r when 55 then 'Super Engaged' when 45 then 'Highly Engaged' when 54 then 'Active Loyalist' when 44 then 'Engaged Regular'
   when 34 then 'Regular w/Potential' when 35 then 'Regular w/Potential' when 43 then 'At-Risk Regular' when 53 then 'At-Risk Regular' when 33 then 'Moderate Engager'
   when 14 then 'Relatively New Buyer' when 24 then 'Relatively New Buyer' when 15 then 'New Buyer' when 25 then 'New Active Buyer'
   when 21 then 'Lapsed Buyer' when 22 then 'Lapsed Buyer' when 31 then 'Lapsed Buyer' when 32 then 'Lapsed Buyer' when 11 then 'Inactive'
   when 41 then 'Lost Buyer' when 51 then 'Lost Buyer' when 12 then 'Losing 1-Time Buyer' when 13 then 'Losing 1-Time Buyer' when 23 then 'Nurture Potential'
   when 42 then 'Inactive Regular' when 52 then 'Inactive Regular' else 'Unclassified' end as customer_classification,
  coalesce(g.customer_group_code, 'Not Registered') as customer_group
 from s left join (select lower(email) as l, arg_min(email, customer_id) as email, arg_min(customer_group_id, customer_id) as customer_group_id
  from {{magento_customer_entity}} group by 1) a on {'a.email' if account == 'email' else 'a.l'} = s.customer_email left join {{customer_groups}} g using (customer_group_id)"""


M["d_customer_segmentation"] = segmentation_sql()
M["segmentation_normalized"] = segmentation_sql("lower(customer_email)", "lower")
M["d_store"] = """select store_code as code, store_name as name, group_id, store_id, is_active, sort_order, website_id from {magento_store}"""


# --- assembly ----------------------------------------------------------------------
def _names(text: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(text) if f]


def assemble(text: str) -> str:
    """A runnable statement: everything the text names, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE or name in order:
            return
        body = M.get(name, VIEWS.get(name))
        if body is None:
            raise KeyError(name)
        for needed in _names(body):
            visit(needed)
        order.append(name)

    for name in _names(text):
        visit(name)

    def plain(body: str) -> str:
        return body.format(**{n: n for n in set(_names(body))})

    ctes = ",\n".join(f"{n} as ({plain(M.get(n, VIEWS.get(n)))})" for n in order)
    return f"with {ctes}\n{plain(text)}" if ctes else plain(text)


def rounded(text: str, digits: dict[str, int]) -> str:
    """The statement with its fractional columns as rounded doubles.

    Values are moved off exact ties first, as on the Spark side.
    """
    if not digits:
        return text
    casts = ", ".join(f"round(cast({c} as double) + sign(cast({c} as double)) * 1e-{d + 3}, {d}) as {c}" for c, d in digits.items())
    return f"select * replace ({casts}) from ({text})"
