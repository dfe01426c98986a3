"""Product dimension: attributes, option lookups, taxonomy, enrichment, use type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.functions.scalars import id_list, ilike_any, ladder
from stocktally.operators.aggregates import ordered_text, pivot_max
from stocktally.operators.windows import first_per_key
from stocktally.sources.tables import Tables


def _store_scope(df: DataFrame, cfg: RetailConfig) -> DataFrame:
    return df.filter(F.col("store_id") == cfg.default_store_id)


def product_attributes(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Named attributes of a product, pivoted from the typed value tables."""
    wanted = dict(cfg.text_attributes)
    values = None
    for kind in ("varchar", "text", "decimal"):
        branch = _store_scope(t[f"magento_catalog_product_entity_{kind}"], cfg).select(
            "entity_id", "attribute_id", F.col("value").cast("string").alias("value")
        )
        values = branch if values is None else values.unionByName(branch)
    # Entities that carry only other attributes keep a row of NULLs.
    known = t["magento_eav_attribute"].select("attribute_id", "attribute_code")
    listed = F.col("attribute_code").isin(list(_ATTRIBUTE_CODES))
    rows = values.join(known.filter(listed), "attribute_id")
    return pivot_max(rows, ["entity_id"], "attribute_code", "value", wanted)


# Attribute codes that make a product appear in the attribute table.
_ATTRIBUTE_CODES = (
    "name", "url_key", "manufacturer_sku", "upc", "image", "cost", "price", "status",
    "visibility", "weight", "manufacturer", "attribute_set_name", "brand_type",
    "grain_weight", "unit_type", "projectile", "caliber", "boxes_case", "rounds_package",
    "suggested_use", "gun_type", "ddcaliber", "capacity", "ddaction", "ddcondition",
    "material", "ddgun_parts", "primary_category", "ddcolor", "optic_coating",
    "ddweapons_platform", "thread_pattern", "thread_type", "model", "dd_suggested_use",
)


def option_lookups(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Attributes stored as option ids, resolved to their labels."""
    option_ids, plain = dict(cfg.option_attributes), dict(cfg.varchar_attributes)
    options = _store_scope(t["magento_eav_attribute_option_value"], cfg).select(
        "option_id", F.col("value").alias("label")
    )
    ints = _store_scope(t["magento_catalog_product_entity_int"], cfg).filter(F.col("attribute_id").isin(list(option_ids)))
    by_option = pivot_max(
        ints.join(options, F.col("value") == F.col("option_id")), ["entity_id"], "attribute_id", "label", option_ids
    )
    texts = _store_scope(t["magento_catalog_product_entity_varchar"], cfg).filter(F.col("attribute_id").isin(list(plain)))
    by_text = pivot_max(texts, ["entity_id"], "attribute_id", "value", plain)

    long_text = _store_scope(t["magento_catalog_product_entity_text"], cfg)
    coating_id = t["magento_eav_attribute"].filter(F.col("attribute_code") == "optic_coating").select("attribute_id")
    coating = long_text.join(coating_id, "attribute_id").select("entity_id", F.col("value").alias("optic_coating"))

    listed = (
        long_text.filter(F.col("attribute_id") == cfg.suggested_use_attribute_id)
        .select("entity_id", F.explode(id_list("value")).alias("option_id"))
        .filter(F.col("option_id").isNotNull())
    )
    uses = ordered_text(listed.join(options, "option_id"), ["entity_id"], "label", ", ", "dd_suggested_use")

    result = t["magento_catalog_product_entity"].select(F.col("product_entity_id").alias("entity_id"))
    for part in (by_option, by_text, coating, uses):
        result = result.join(part, "entity_id", "left")
    order = ["entity_id", "manufacturer", "projectile", "unit_type", "rounds_package", "capacity", "material",
             "primary_category", "ddcaliber", "ddaction", "ddcondition", "ddgun_parts", "ddcolor",
             "optic_coating", "ddweapons_platform", "dd_suggested_use"]
    return result.select(*order)


def taxonomy(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Category path and newest parent SKU per product."""
    name_id = t["magento_eav_attribute"].filter(F.col("attribute_code") == "name").select("attribute_id")
    labels = t["magento_catalog_category_entity_varchar"].join(name_id, "attribute_id", "left_semi").select(
        F.col("entity_id").alias("category_id"), "value"
    )
    links = t["magento_catalog_category_product"].select("category_id", "product_id")
    paths = ordered_text(links.join(labels, "category_id"), ["product_id"], "value", " > ", "categories")
    skus = t["magento_catalog_product_entity"].select(F.col("product_entity_id").alias("parent_id"), F.col("sku").alias("parent_sku"))
    parents = first_per_key(
        t["magento_catalog_product_super_link"].select("product_id", "parent_id").join(skus, "parent_id"),
        ["product_id"], [F.col("parent_id").desc_nulls_first()],
    ).select("product_id", "parent_sku")
    products = t["magento_catalog_product_entity"].select(F.col("product_entity_id").alias("entity_id"))
    keyed = products.withColumn("product_id", F.col("entity_id"))
    return keyed.join(paths, "product_id", "left").join(parents, "product_id", "left").select(
        "entity_id", "categories", "parent_sku"
    )


def product_conversion_factors(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Pieces per unit, average cost and last vendor cost per product number."""
    last_cost = first_per_key(
        t["fishbowl_vendor_parts"].select("partid", "datelastmodified", "lastcost", "id"), ["partid"],
        [F.col("datelastmodified").desc_nulls_first(), F.col("id").desc_nulls_last()],
    ).select(F.col("partid").alias("part_id"), "lastcost")
    to_base = t["fishbowl_uomconversion"].filter(F.col("to_uom_id") == cfg.base_uom_id).select(
        F.col("from_uom_id").alias("uom_id"), "multiply_factor"
    )
    costs = t["fishbowl_partcost"].select("part_id", "average_cost")
    return (
        t["fishbowl_product"].select("product_number", "uom_id", "part_id")
        .join(to_base, "uom_id", "left").join(costs, "part_id", "left").join(last_cost, "part_id", "left")
        .groupBy("product_number").agg(
            F.avg("multiply_factor").alias("conversion_factor"),
            F.avg("average_cost").alias("avgcost"), F.avg("lastcost").alias("lastvendorcost"),
        )
    )


def enrichment(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Vendor, discontinued flag, attribute set and cost per product."""
    products = t["magento_catalog_product_entity"].select(
        F.col("product_entity_id").alias("entity_id"), "sku", "attribute_set_id"
    )
    sets = t["magento_eav_attribute_set"].select("attribute_set_id", "attribute_set_name")
    vendor_ids = t["magento_catalog_product_entity_int"].filter(F.col("attribute_id") == cfg.vendor_attribute_id)
    labels = t["magento_eav_attribute_option_value"].select("option_id", F.col("value").alias("label"))
    vendors = (
        vendor_ids.select("entity_id", F.col("value").alias("option_id")).join(labels, "option_id")
        .groupBy("entity_id").agg(F.max("label").alias("vendor"))
    )
    factors = product_conversion_factors(t, cfg).withColumnRenamed("product_number", "sku")
    gone = F.when(F.col("attribute_set_id") == cfg.discontinued_attribute_set_id, "Yes").otherwise("No")
    per_product = (
        products.withColumn("discontinued", gone)
        .join(sets, "attribute_set_id", "left").join(vendors, "entity_id", "left").join(factors, "sku", "left")
    )
    return per_product.groupBy("entity_id", "sku").agg(
        F.max("vendor").alias("vendor"), F.max("discontinued").alias("discontinued"),
        F.max("attribute_set_name").alias("attribute_set_name"),
        F.coalesce(F.max("conversion_factor"), F.lit(1)).alias("convert"),
        F.max("avgcost").alias("avgcost"), F.max("lastvendorcost").alias("lastvendorcost"),
    )


def use_type(cfg: RetailConfig = DEFAULT) -> Column:
    """Use-type class of a product. Keyword and projectile rules first, caliber after."""
    projectile, caliber = F.col("projectile"), F.col("dd_caliber")
    name, groups, purpose = F.col("product_name"), F.col("categories"), F.col("general_purpose")

    def named(*words: str) -> Column:
        return ilike_any(name, words)

    def anywhere(word: str) -> Column:
        return groups.ilike(f"%{word}%") | purpose.ilike(f"%{word}%") | named(word)

    def bullet(values) -> Column:
        return projectile.isin(list(values))

    def bore(values) -> Column:
        return caliber.isin(list(values))

    hunting, defense = "Hunting", "Self-Defense/Personal Protection"
    tactical, sporting = "Tactical/Law Enforcement", "Sporting/Target"
    by_rule = [
        (anywhere("hunting") | bullet(cfg.hunting_projectiles)
         | (bore(cfg.hunting_calibers) & ~bullet(cfg.non_hunting_projectiles)), hunting),
        (anywhere("defense") | named("personal") | bullet(cfg.defense_projectiles)
         | (bore(cfg.defense_calibers) & ((projectile == "HP") | named("carry")))
         | projectile.like("%Buck%"), defense),
        (anywhere("tactical") | groups.ilike("%law enforcement%") | named("duty", "law enforcement")
         | (projectile == "SS109/Green Tip")
         | (bore(cfg.tactical_calibers) & bullet(cfg.tactical_projectiles)), tactical),
        (ilike_any(groups, ("sport", "target", "competition")) | purpose.ilike("%sport%")
         | named("target", "competition", "match", "practice", "range")
         | (bullet(cfg.sporting_projectiles) & ~named("defense", "tactical"))
         | bullet(cfg.sporting_shot_types) | (caliber == "22 LR"), sporting),
        (groups.ilike("%collector%") | named("collector", "limited", "special edition"), "Collector/Specialty"),
    ]
    shot = ladder([(bullet(cfg.shotgun_defense_shot) & ~bullet(cfg.shotgun_sporting_shot), F.lit(defense))], sporting)
    by_caliber = [
        (bore(cfg.sporting_fallback_calibers), sporting), (bore(cfg.hunting_fallback_calibers), hunting),
        (bore(cfg.defense_fallback_calibers), defense), (bore(cfg.tactical_fallback_calibers), tactical),
        (bore(cfg.shotgun_gauges), shot),
        (bullet(("FMJ", "TMJ", "Ball", "LRN", "LFN")), sporting), (bullet(("JHP", "HP", "XTP")), defense),
        (bullet(("SP", "JSP", "BTSP")), hunting),
    ]
    return ladder(by_rule + by_caliber, "Unclassified")


def product_dimension(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """One row per product with all descriptive columns."""
    base = t["int_fishbowl_product_enrichment"]
    for name in ("int_magento_product_attributes", "int_magento_product_eav_lookups", "int_magento_product_taxonomy"):
        base = base.join(t[name], "entity_id", "left")
    trimmed = {
        "caliber": "caliber", "manufacturer_sku": "manufacturer_sku", "manufacturer": "manufacturer",
        "projectile": "projectile", "unit_type": "unit_type", "attribute_set": "attribute_set_name",
        "gun_type": "gun_type", "dd_caliber": "ddcaliber", "dd_gun_action": "ddaction",
        "dd_condition": "ddcondition", "dd_gun_parts": "ddgun_parts", "capacity": "capacity",
        "material": "material", "primary_category": "primary_category", "dd_color": "ddcolor",
    }
    site = cfg.base_url
    shaped = base.select(
        F.col("entity_id").alias("product_id"), "sku", "product_name", "general_purpose",
        F.concat(F.lit(site + "/"), "url_key").alias("product_url"),
        F.concat(F.lit(site + "/media/catalog/product"), "image").alias("product_image_url"),
        "vendor", "discontinued", "parent_sku", F.coalesce("parent_sku", "sku").alias("grouped_sku"),
        "boxes_case", "upc", "rounds_package", "categories", "optic_coating",
        F.col("ddweapons_platform").alias("dd_weapons_platform"), "thread_pattern", "thread_type", "model",
        "convert", "avgcost", "lastvendorcost", "dd_suggested_use",
        *[F.trim(source).alias(out) for out, source in trimmed.items()],
    )
    return shaped.withColumn("use_type_category", use_type(cfg))


# Presentation names of the product table.
PRODUCT_LABELS = {
    "product_id": "Product ID", "sku": "SKU", "product_name": "Product Name", "general_purpose": "General Purpose",
    "product_url": "Product URL", "product_image_url": "Product Image URL", "vendor": "Vendor",
    "discontinued": "Discontinued", "parent_sku": "Parent SKU", "grouped_sku": "GROUPED_SKU",
    "boxes_case": "Boxes/Case", "caliber": "Caliber", "manufacturer_sku": "Manufacturer SKU", "upc": "UPC",
    "manufacturer": "Manufacturer", "projectile": "Projectile", "unit_type": "Unit Type",
    "rounds_package": "Rounds/Package", "attribute_set": "Attribute Set", "categories": "Categories",
    "gun_type": "Gun Type", "dd_caliber": "DD Caliber", "dd_gun_action": "DD Gun Action",
    "dd_condition": "DD Condition", "dd_gun_parts": "DD Gun Parts", "capacity": "Capacity",
    "material": "Material", "primary_category": "Primary Category", "dd_color": "DD Color",
    "optic_coating": "Optic Coating", "dd_weapons_platform": "DD Weapons Platform",
    "thread_pattern": "Thread Pattern", "thread_type": "Thread Type", "model": "Model", "convert": "CONVERT",
    "avgcost": "AVGCOST", "lastvendorcost": "LASTVENDORCOST", "dd_suggested_use": "DD Suggested Use",
    "use_type_category": "USE_TYPE_CATEGORY",
}


def product_presentation(products: DataFrame) -> DataFrame:
    """The product table under its report names."""
    return products.select([F.col(c).alias(label) for c, label in PRODUCT_LABELS.items()])


def product_analyst(t: Tables) -> DataFrame:
    """Narrow product table for analysis; the manufacturer is the manufacturer's SKU."""
    return t["d_product"].select(
        "product_id", "sku", "product_name", "caliber", F.col("manufacturer_sku").alias("manufacturer"), "projectile",
        F.col("vendor").alias("product_vendor"), "use_type_category", "primary_category", "discontinued", "unit_type",
        "avgcost", "lastvendorcost", "general_purpose",
    )


def product_bundle(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Kit components with the pieces each contributes."""
    numbers = t["fishbowl_product"].select("product_id", "product_number")
    component = numbers.select(F.col("product_id").alias("component_product_id"), F.col("product_number").alias("individual_num"))
    kit = numbers.select(F.col("product_id").alias("kit_product_id"), F.col("product_number").alias("num_bundle"))
    wanted = F.lit(True)
    for pattern in cfg.bundle_exclude_patterns:
        wanted = wanted & ~F.col("individual_num").like(pattern)
    to_base = t["fishbowl_uomconversion"].filter(F.col("to_uom_id") == cfg.base_uom_id).select(
        F.col("from_uom_id").alias("uom_id"), "multiply_factor"
    )
    factors = (
        t["fishbowl_product"].select("product_number", "uom_id").join(to_base, "uom_id", "left")
        .groupBy(F.col("product_number").alias("individual_num"))
        .agg(F.avg("multiply_factor").alias("conversion_factor"))
    )
    return (
        t["fishbowl_kititem"].filter(F.col("kit_type_id") == cfg.kit_type_id)
        .select("component_product_id", "kit_product_id", "default_quantity")
        .join(component, "component_product_id", "left").join(kit, "kit_product_id", "left").filter(wanted)
        .join(factors, "individual_num", "left")
        .select(
            "component_product_id", "kit_product_id", "individual_num", "default_quantity", "num_bundle",
            (F.coalesce("conversion_factor", F.lit(1)) * F.col("default_quantity")).alias("conversion_rate"),
            F.lit("KIT").alias("kit_type"),
        )
    )


def builders(cfg: RetailConfig = DEFAULT) -> dict:
    return {
        "int_magento_product_attributes": lambda t: product_attributes(t, cfg),
        "int_magento_product_eav_lookups": lambda t: option_lookups(t, cfg),
        "int_magento_product_taxonomy": lambda t: taxonomy(t, cfg),
        "int_fishbowl_product_enrichment": lambda t: enrichment(t, cfg),
        "d_product": lambda t: product_dimension(t, cfg),
        "int_product_analyst": product_analyst,
        "d_product_bundle": lambda t: product_bundle(t, cfg),
    }
