"""Stock quantities per part and location group."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.config import DEFAULT, RetailConfig
from stocktally.functions.scalars import uom_convert
from stocktally.sources.tables import Tables

GROUP = ["part_id", "location_group_id"]


@dataclass(frozen=True)
class LineQuantity:
    """An order-line quantity: which lines count, whose location, how much is open.

    `location` names the header column that supplies the location group. The
    transfer specs state it on both sides on purpose: what is on order to receive
    sits at the sending group and the other way round.
    """

    header: str
    line: str
    link: str
    quantity: tuple[str, ...]
    lines: Callable[[], Column]
    out: str
    location: str = "location_group_id"
    via_product: bool = False


def _open_sales() -> Column:
    return F.col("h_status").isin(20, 25)


def _xfer(kind: int) -> Callable[[], Column]:
    return lambda: (
        F.col("h_status").isin(20, 30, 40, 50, 60)
        & F.col("l_status").isin(10, 20, 30, 40, 50)
        & (F.col("l_type") == kind)
    )


# How each source names status and type: header status, line status, line type.
_STATUS = {
    "fishbowl_so": "status_id", "fishbowl_po": "po_status_id", "fishbowl_wo": "status_id",
    "fishbowl_xo": "status_id", "fishbowl_receipt": "order_type_id",
}
_LINE = {
    "fishbowl_soitem": ("status_id", "item_type_id"),
    "fishbowl_poitem": ("po_item_status_id", "po_item_type_id"),
    "fishbowl_woitem": (None, "item_type_id"),
    "fishbowl_xoitem": ("item_status_id", "item_type_id"),
    "fishbowl_receiptitem": ("receipt_item_status_id", None),
}

_SO = dict(header="fishbowl_so", line="fishbowl_soitem", link="sales_order_id",
           quantity=("quantity_to_fulfill", "quantity_fulfilled"), via_product=True)
_WO = dict(header="fishbowl_wo", line="fishbowl_woitem", link="work_order_id", quantity=("quantity_target",))
_XO = dict(header="fishbowl_xo", line="fishbowl_xoitem", link="transfer_order_id",
           quantity=("quantity_to_fulfill", "quantity_fulfilled"))

# The status and type ids that define each quantity.
LINE_QUANTITIES: dict[str, LineQuantity] = {
    "allocated_so": LineQuantity(
        **_SO, out="quantity_allocated_to_so",
        lines=lambda: _open_sales() & F.col("l_status").isin(10, 14, 20, 30, 40) & F.col("l_type").isin(10, 12)),
    "allocated_po": LineQuantity(
        header="fishbowl_po", line="fishbowl_poitem", link="purchase_order_id",
        quantity=("quantity_ordered", "quantity_fulfilled"), out="quantity_allocated_to_po",
        lines=lambda: F.col("h_status").between(20, 55) & F.col("l_status").isin(10, 20, 30, 40, 45)
        & F.col("l_type").isin(20, 30)),
    "allocated_mo": LineQuantity(
        **_WO, out="quantity_allocated_to_mo",
        lines=lambda: (F.col("h_status") < 40) & F.col("l_type").isin(20, 30)),
    "allocated_to_send": LineQuantity(
        **_XO, out="quantity_allocated_to_send", location="from_location_group_id", lines=_xfer(10)),
    "allocated_to_receive": LineQuantity(
        **_XO, out="quantity_allocated_to_receive", location="to_location_group_id", lines=_xfer(20)),
    "dropship": LineQuantity(
        **_SO, out="quantity_dropship",
        lines=lambda: _open_sales() & F.col("l_status").isin(10, 14, 20, 30, 40) & (F.col("l_type") == 12)),
    "on_order_po": LineQuantity(
        header="fishbowl_receipt", line="fishbowl_receiptitem", link="receipt_id",
        quantity=("quantity_received",), out="quantity_on_order_po",
        lines=lambda: (F.col("h_status") == 10) & F.col("l_status").isin(10, 20)),
    "on_order_so": LineQuantity(
        **_SO, out="quantity_on_order_so",
        lines=lambda: _open_sales() & F.col("l_status").isin(10, 14, 30) & (F.col("l_type") == 20)),
    "on_order_mo": LineQuantity(
        **_WO, out="quantity_on_order_mo",
        lines=lambda: (F.col("h_status") < 40) & F.col("l_type").isin(10, 31)),
    "on_order_to_send": LineQuantity(
        **_XO, out="quantity_on_order_to_send", location="to_location_group_id", lines=_xfer(10)),
    "on_order_to_receive": LineQuantity(
        **_XO, out="quantity_on_order_to_receive", location="from_location_group_id", lines=_xfer(20)),
}


def open_lines(t: Tables, names: Sequence[str]) -> DataFrame:
    """Open quantities per part, location group and unit, one column for each of several quantities.

    Quantities over the same header and line share one join and one aggregate: a line is
    added to the sum of every quantity it counts for. Sums per item come before the item
    tables are joined, so a hot item shrinks to a few rows per task.
    """
    families: dict[tuple[str, str], list[str]] = {}
    for name in names:
        spec = LINE_QUANTITIES[name]
        families.setdefault((spec.header, spec.line), []).append(name)
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [_family(t, kinds) for kinds in families.values()])


def _family(t: Tables, kinds: Sequence[str]) -> DataFrame:
    specs = {k: LINE_QUANTITIES[k] for k in kinds}
    first = specs[kinds[0]]
    l_status, l_type = _LINE[first.line]
    nothing = F.lit(None).cast("int")
    open_qty = F.col(first.quantity[0])
    for done in first.quantity[1:]:
        open_qty = open_qty - F.col(done)
    lines = t[first.line].select(
        first.link, F.col("product_id" if first.via_product else "part_id").alias("l_item"), F.col("uom_id").alias("l_uom"),
        (F.col(l_status) if l_status else nothing).alias("l_status"),
        (F.col(l_type) if l_type else nothing).alias("l_type"), open_qty.alias("l_qty"),
    )
    places = sorted({s.location for s in specs.values()})
    headers = t[first.header].select(first.link, F.col(_STATUS[first.header]).alias("h_status"), *places)
    # The union of the conditions reaches both scans before the shuffle.
    joined = lines.join(headers, first.link).filter(reduce(or_, (s.lines() for s in specs.values())))
    at = {p: [k for k, s in specs.items() if s.location == p] for p in places}
    summed = joined.groupBy("l_item", "l_uom", *places).agg(
        *[F.sum(F.when(s.lines(), F.col("l_qty"))).alias(k) for k, s in specs.items()],
        *[F.count_if(reduce(or_, (specs[k].lines() for k in at[p]))).alias(f"n_{p}") for p in places],
    )
    if len(places) > 1:
        # Transfers count at two places: one row of sums for each of them.
        empty = {k: F.lit(None).cast(summed.schema[k].dataType) for k in kinds}
        rows = [
            F.struct(F.col(p).alias("location_group_id"), F.col(f"n_{p}").alias("n"), *[(F.col(k) if k in at[p] else empty[k]).alias(k) for k in kinds])
            for p in places
        ]
        summed = summed.select("l_item", "l_uom", F.inline(F.array(*rows))).filter(F.col("n") > 0)
    else:
        summed = summed.withColumnRenamed(places[0], "location_group_id")
    if first.via_product:
        products = t["fishbowl_product"].select(F.col("product_id").alias("l_item"), "part_id")
        summed = summed.join(products, "l_item")
    else:
        summed = summed.withColumnRenamed("l_item", "part_id")
    return summed.select(*GROUP, "l_uom", *kinds)


def in_part_units(t: Tables, lines: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Open lines per part and location group, with every quantity in the part's own unit."""
    parts = t["fishbowl_part"].select("part_id", "default_uom_id")
    conversions = t["fishbowl_uomconversion"].select(
        F.col("to_uom_id").alias("default_uom_id"), F.col("from_uom_id").alias("l_uom"), "multiply_factor", "factor"
    )
    return lines.join(parts, "part_id").join(conversions, ["default_uom_id", "l_uom"], "left").select(
        *GROUP, *[uom_convert(k, "l_uom", "default_uom_id", "multiply_factor", "factor").alias(k) for k in kinds]
    )


def line_quantity(t: Tables, name: str) -> DataFrame:
    return _total(t, [name], LINE_QUANTITIES[name].out)


def _free() -> Column:
    return F.col("quantity_on_tag") - F.col("quantity_committed_on_tag")


def _held(flag: str) -> Column:
    return ~F.col(flag) & (F.col("location_type_id") != 100)


# kind: tag amount, location condition. All of them count stock tags only.
_TAG_KINDS: dict[str, tuple[Callable[[], Column], Callable[[], Column]]] = {
    "on_hand": (lambda: F.col("quantity_on_tag"), lambda: F.lit(True)),
    "not_available": (_free, lambda: _held("is_counted_as_available")),
    "not_available_to_pick": (_free, lambda: _held("is_pickable")),
}


def _placed_tags(t: Tables) -> DataFrame:
    tags = t["fishbowl_tag"].select("part_id", "location_id", "tag_type_id", "quantity_on_tag", "quantity_committed_on_tag")
    places = t["fishbowl_location"].select(
        "location_id", "location_group_id", "location_type_id", "is_pickable", "is_counted_as_available"
    )
    return tags.join(places, "location_id")


def stock_tags(t: Tables, kinds: Sequence[str] = tuple(_TAG_KINDS)) -> DataFrame:
    """Tag quantities per part and location group, one column each, from one join."""
    conditions = {k: _TAG_KINDS[k][1]() for k in kinds}
    stock = _placed_tags(t).filter(F.col("tag_type_id").isin(30, 40)).filter(reduce(or_, conditions.values()))
    return stock.groupBy(*GROUP).agg(*[F.sum(F.when(conditions[k], _TAG_KINDS[k][0]())).alias(k) for k in kinds])


def _tag_total(t: Tables, kind: str) -> DataFrame:
    return stock_tags(t, [kind]).select(*GROUP, F.coalesce(kind, F.lit(0)).alias("quantity_" + kind))


def on_hand(t: Tables) -> DataFrame:
    return _tag_total(t, "on_hand")


def not_available(t: Tables) -> DataFrame:
    return _tag_total(t, "not_available")


def not_available_to_pick(t: Tables) -> DataFrame:
    return _tag_total(t, "not_available_to_pick")


def committed(t: Tables) -> DataFrame:
    """Committed stock on tags of every type."""
    return _placed_tags(t).groupBy(*GROUP).agg(F.coalesce(F.sum("quantity_committed_on_tag"), F.lit(0)).alias("quantity_committed"))


_ALLOCATED = ("allocated_so", "allocated_po", "allocated_to_send", "allocated_to_receive", "allocated_mo")
_ON_ORDER = ("on_order_so", "on_order_po", "on_order_to_send", "on_order_to_receive", "on_order_mo")


def _total(t: Tables, names: Sequence[str], out: str) -> DataFrame:
    lines = in_part_units(t, open_lines(t, names), names)
    return lines.groupBy(*GROUP).agg(reduce(add, [F.coalesce(F.sum(k), F.lit(0)) for k in names]).alias(out))


def allocated(t: Tables) -> DataFrame:
    return _total(t, _ALLOCATED, "total_quantity_allocated")


def on_order(t: Tables) -> DataFrame:
    return _total(t, _ON_ORDER, "total_quantity_on_order")


def quantities(t: Tables) -> DataFrame:
    """All quantity kinds side by side, one row per part and location group.

    The overall allocated total is not a column here, and a part and group known
    to it is known to one of its branches, so it is left out of the union.
    """
    lines = in_part_units(t, open_lines(t, list(LINE_QUANTITIES)), list(LINE_QUANTITIES))
    everything = lines.unionByName(stock_tags(t), allowMissingColumns=True)
    wide = everything.groupBy(*GROUP).agg(
        *[F.coalesce(F.sum(k), F.lit(0)).alias("quantity_" + k) for k in (*_TAG_KINDS, *LINE_QUANTITIES)]
    )
    return wide.select(
        *GROUP, "quantity_on_hand", "quantity_allocated_po", "quantity_allocated_so", "quantity_allocated_mo",
        (F.col("quantity_allocated_to_receive") + F.col("quantity_allocated_to_send")).alias("quantity_allocated_transfer_order"),
        "quantity_not_available", "quantity_not_available_to_pick", "quantity_dropship",
        "quantity_on_order_po", "quantity_on_order_so",
        (F.col("quantity_on_order_to_receive") + F.col("quantity_on_order_to_send")).alias("quantity_on_order_transfer_order"),
        "quantity_on_order_mo",
    )


def totals(t: Tables) -> DataFrame:
    def total(kind: str) -> Column:
        return sum((F.col(f"quantity_{kind}_{s}") for s in ("so", "transfer_order", "mo")), F.col(f"quantity_{kind}_po"))

    return t["inventory_qtyinventory"].select(
        *GROUP, "quantity_on_hand", total("allocated").alias("quantity_allocated"),
        "quantity_not_available", "quantity_not_available_to_pick", "quantity_dropship",
        total("on_order").alias("quantity_on_order"),
    )


def serial_on_hand(t: Tables) -> DataFrame:
    """On hand per tag and serial number; a serialised tag counts its serials."""
    keys = ["location_group_id", "location_id", "part_id", "tag_number", "serial_number", "quantity_on_tag"]
    places = t["fishbowl_location"].select("location_id", "location_group_id")
    tags = t["fishbowl_tag"].filter(F.col("part_id").isNotNull() & F.col("tag_number").isNotNull()).select(
        "tag_id", "location_id", "part_id", "tag_number", "quantity_on_tag"
    )
    serials = t["fishbowl_tagserialview"].select("tag_id", F.col("serial_number_value").alias("serial_number"))
    counted = tags.join(places, "location_id").join(serials, "tag_id", "left").groupBy(*keys).agg(
        F.count("serial_number").alias("serials")
    )
    calc = (1 - F.col("quantity_on_tag")) * (F.col("serials") - 1) + 1
    return counted.select(*keys[:-1], calc.alias("calculated_quantity_on_hand"))


def tag_serial_view(t: Tables) -> DataFrame:
    """Serial numbers of tags with their tracking definition."""
    serial = t["fishbowl_serial"].select("serial_id", "tag_id", "is_committed")
    number = t["fishbowl_serialnum"].select(
        F.col("serial_number_id").alias("serial_id"), "part_tracking_id", "serial_num_record_id", "serial_number_value"
    )
    tracking = t["fishbowl_parttracking"].select(
        "part_tracking_id", "part_tracking_name", "part_tracking_abbreviation", "part_tracking_description",
        F.col("sort_order").alias("part_tracking_sort_order"), "part_tracking_type_id",
        F.col("is_active").alias("is_part_tracking_active"),
    )
    return number.join(serial, "serial_id").join(tracking, "part_tracking_id").select(
        "part_tracking_id", "serial_id", "part_tracking_name", "part_tracking_abbreviation",
        "part_tracking_description", "part_tracking_sort_order", "part_tracking_type_id", "tag_id",
        "serial_num_record_id", "serial_number_value", "is_committed", "is_part_tracking_active",
    )


def inventory_view(t: Tables, cfg: RetailConfig = DEFAULT) -> DataFrame:
    """Stock and value per part number in the default location group.

    Extended cost is total quantity times the highest average cost of the number.
    """
    stock = t["inventory_qtyinventorytotals"].filter(F.col("location_group_id") == cfg.default_location_group_id)
    parts = t["fishbowl_part"].select("part_id", "part_number")
    costs = t["fishbowl_partcost"].select("part_id", "average_cost")
    zero = F.lit(0)
    rows = stock.join(parts, "part_id", "left").join(costs, "part_id", "left")
    summed = rows.groupBy("part_number").agg(
        F.sum(F.coalesce("quantity_on_hand", zero)).alias("qty_available"),
        F.sum(F.coalesce("quantity_not_available", zero)).alias("qty_not_available"),
        F.sum(F.coalesce("quantity_on_order", zero)).alias("qty_on_order"),
        F.max(F.coalesce("average_cost", zero)).alias("part_cost"),
    )
    return summed.withColumn("extended_cost", F.col("qty_available") * F.col("part_cost"))


def builders(cfg: RetailConfig = DEFAULT) -> dict:
    """Names under which the stock tables are known."""
    model = {
        "allocated_so": "qtyallocatedso", "allocated_po": "qtyallocatedpo", "allocated_mo": "qtyallocatedmo",
        "allocated_to_send": "qtyallocatedtosend", "allocated_to_receive": "qtyallocatedtoreceive",
        "dropship": "qtydropship", "on_order_po": "qtyonorderpo", "on_order_so": "qtyonorderso",
        "on_order_mo": "qtyonordermo", "on_order_to_send": "qtyonordertosend",
        "on_order_to_receive": "qtyonordertoreceive",
    }
    result = {f"inventory_{m}": (lambda t, n=n: line_quantity(t, n)) for n, m in model.items()}
    result |= {
        "inventory_qtyonhand": on_hand, "inventory_qtynotavailable": not_available,
        "inventory_qtynotavailabletopick": not_available_to_pick, "inventory_qtycommitted": committed,
        "inventory_qtyallocated": allocated, "inventory_qtyonorder": on_order,
        "inventory_qtyinventory": quantities, "inventory_qtyinventorytotals": totals,
        "inventory_qohview": serial_on_hand, "inventory_tagserialviewview": tag_serial_view,
        "f_inventoryview": lambda t: inventory_view(t, cfg),
    }
    return result
