"""Business constants. All thresholds, ids and lists live in one frozen record."""

from __future__ import annotations

from dataclasses import dataclass


# They must equal the warehouse's for the results to agree.
@dataclass(frozen=True)
class RetailConfig:
    timezone: str = "America/New_York"
    default_customer_email: str = "customer@nonidentified.com"
    base_url: str = "https://shop.example.com"
    free_shipping_threshold: float = 140
    default_location_group_id: int = 8
    valid_order_statuses: tuple[str, ...] = ("PROCESSING", "COMPLETE", "UNVERIFIED")

    kit_relationship_type_id: int = 30
    sale_item_type_id: int = 10
    kit_type_id: int = 10
    receipt_order_type_id: int = 10
    base_uom_id: int = 1
    default_store_id: int = 0
    discontinued_attribute_set_id: int = 50
    receipt_statuses: tuple[int, ...] = (10, 40)

    excluded_order_skus: tuple[str, ...] = (
        "00-CSG", "00-Replacement", "00-Replacement-1", "00-Marketing",
    )
    unweighted_sku_pattern: str = "%parceldefender%"
    cost_exclude_product_pattern: str = "%POLLYAMOBAG%"
    bundle_exclude_patterns: tuple[str, ...] = ("%POLLYAMOBAG%", "%POLYAMMOBAG%")

    marketplace_prefix: str = "GB"
    marketplace_name: str = "GunBroker"
    default_store_name: str = "Website"
    lead_time_rank_limit: int = 3
    default_lead_time_days: int = 14
    overstock_days: int = 90
    lookback_days: int = 3
    realtime_days: int = 4
    min_series_days: int = 90

    # Recency, frequency, value and margin bands.
    frequency_bands: tuple[int, int, int] = (2, 3, 5)
    recency_label_bands: tuple[int, ...] = (30, 60, 180, 240, 365)
    recency_score_bands: tuple[int, ...] = (30, 60, 120, 180, 365)
    value_bands: tuple[float, ...] = (149, 225, 300, 500)
    margin_bands: tuple[float, ...] = (0.20, 0.24, 0.26, 0.30)

    # Attribute ids of the shop's entity-attribute-value tables.
    option_attributes: tuple[tuple[int, str], ...] = (
        (677, "manufacturer"), (681, "projectile"), (649, "unit_type"),
        (678, "ddcaliber"), (718, "ddaction"), (676, "ddcondition"),
        (817, "ddgun_parts"), (878, "primary_category"), (685, "ddcolor"),
        (756, "ddweapons_platform"),
    )
    varchar_attributes: tuple[tuple[int, str], ...] = (
        (152, "rounds_package"), (165, "capacity"), (188, "material"),
    )
    suggested_use_attribute_id: int = 682
    vendor_attribute_id: int = 145
    # attribute code -> output column of the product attribute pivot
    text_attributes: tuple[tuple[str, str], ...] = (
        ("name", "product_name"), ("suggested_use", "general_purpose"),
        ("url_key", "url_key"), ("image", "image"), ("boxes_case", "boxes_case"),
        ("caliber", "caliber"), ("manufacturer_sku", "manufacturer_sku"),
        ("upc", "upc"), ("gun_type", "gun_type"),
        ("thread_pattern", "thread_pattern"), ("thread_type", "thread_type"),
        ("model", "model"),
    )

    # Product use-type lists.
    hunting_projectiles: tuple[str, ...] = (
        "SP", "JSP", "TSX", "TTSX", "Partition", "AccuBond", "Nosler", "SST", "InterLock",
    )
    hunting_calibers: tuple[str, ...] = (
        ".30-06", ".308 Win", ".270 Win", ".243 Win", "7mm Rem Mag", "6.5 Creedmoor",
        "30-06 Springfield", "308/7.62", "270 Win", "243 Win", "300 Win Mag", "7mm-08",
    )
    hunting_fallback_calibers: tuple[str, ...] = (
        "30-06 Springfield", "308/7.62", "270 Win", "243 Win", "300 Win Mag",
        "7mm Rem Mag", "6.5 Creedmoor", "7mm-08", "25-06", "280 Rem", "35 Rem",
    )
    non_hunting_projectiles: tuple[str, ...] = ("FMJ", "TMJ", "RN", "Frangible")
    defense_projectiles: tuple[str, ...] = (
        "JHP", "XTP", "Gold Dot", "HST", "Critical Defense", "Critical Duty",
    )
    defense_calibers: tuple[str, ...] = (
        "9mm", ".45 ACP", ".380 Auto", ".38 Special", ".40 S&W", ".357 Mag", "45 ACP",
        "380 ACP", "38 Special", "40 S&W", "357 Mag", "10mm", "44 Mag",
    )
    defense_fallback_calibers: tuple[str, ...] = (
        "9mm", "45 ACP", "380 ACP", "38 Special", "40 S&W", "357 Mag", "10mm",
        "44 Mag", "45 LC",
    )
    tactical_calibers: tuple[str, ...] = ("5.56 NATO", "223/5.56", "300 Blackout")
    tactical_projectiles: tuple[str, ...] = ("HP", "OTM", "BTHP")
    tactical_fallback_calibers: tuple[str, ...] = (
        "223/5.56", "300 Blackout", "308 Win Match", "338 Lapua",
    )
    sporting_projectiles: tuple[str, ...] = ("FMJ", "TMJ", "FMJBT", "LRN", "LFN")
    sporting_shot_types: tuple[str, ...] = (
        "7.5 Shot", "8 Shot", "9 Shot", "Clay & Target", "Game & Target",
    )
    sporting_fallback_calibers: tuple[str, ...] = (
        "22 LR", "22 Mag/WMR", "17 HMR", "22-250", "6mm Creedmoor",
    )
    shotgun_gauges: tuple[str, ...] = ("12 Gauge", "20 Gauge", "410 Bore", "28 Gauge")
    shotgun_sporting_shot: tuple[str, ...] = (
        "7.5 Shot", "8 Shot", "9 Shot", "7 Shot", "6 Shot", "5 Shot", "4 Shot",
    )
    shotgun_defense_shot: tuple[str, ...] = (
        "00 Buck", "Slug", "OO Buck", "000 Buck", "4 Buck", "Buckshot", "1 Buck",
        "2 Buck", "3 Buck",
    )

    # Usage-cost analytics.
    credit_price: float = 3.0
    storage_price_per_tb: float = 23.0
    anomaly_multiplier: float = 2.5


DEFAULT = RetailConfig()
