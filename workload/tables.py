"""Spark side of the derived tables."""

from __future__ import annotations

import dataclasses
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stocktally.config import DEFAULT
from stocktally.operators.cdc import cdc_latest
from stocktally.operators.identity import customer_identity
from stocktally.plans.build import gold_builders
from stocktally.session import tune_model
from stocktally.sources.tables import Tables
from workload.retail_views import BASE, VIEWS

AS_OF = "2001-06-15"  # inside the span of the given orders
CFG = dataclasses.replace(DEFAULT, default_location_group_id=3, min_series_days=90)
ITEM_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def names_in(text: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(text) if f]


def _view(name: str) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        text = VIEWS[name]
        frames = {n: t[n] for n in names_in(text)}
        return t["region"].sparkSession.sql(text, **frames) if frames else t["region"].sparkSession.sql(text)

    return build


def items(t: Tables) -> DataFrame:
    """Newest record of every order line."""
    order = [F.col(c).desc_nulls_last() for c in ITEM_ORDER]
    return cdc_latest(t["item_log"], ["l_orderkey", "l_linenumber"], order)


# Written once per session and folder: the cleaned lines and the models many others read.
STORED = (
    "items", "order_lines", "inventory_qtyinventory", "int_item_costs", "int_order_shipments", "int_magento_order_freight",
    "int_magento_product_eav_lookups", "int_sales_cost_fallback", "int_shop_items", "int_receipt_lines", "d_product", "f_sales", "f_pos",
)
_SETS: dict[tuple, Tables] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the files of the given tables."""
    found = []
    for name in BASE:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found += sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
    return tuple(found)


def new_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All derived and modelled tables over one folder, nothing built yet."""
    tune_model(spark, sum(size for _, size, _ in _state(spark, sf_dir)))
    frames = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in BASE}
    builders = {name: _view(name) for name in VIEWS}
    builders |= {"items": items, **gold_builders(CFG, AS_OF)}
    builders["magento_d_customerupdated"] = lambda t: customer_identity(t["magento_sales_order"], "customer_email", CFG.default_customer_email)
    return Tables(builders, frames).stored(STORED)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables of a folder, shared by all queries of a session as long as its files stay the same."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    if key not in _SETS:
        _SETS[key] = new_tables(spark, sf_dir)
    return _SETS[key]
