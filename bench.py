"""Headline queries on one machine. Prints one JSON line.

The pipeline is built from the files, model by model; the analytics run on it.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from stocktally import build_session
from workload.queries import QUERIES
from workload.tables import tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# The pipeline in build order; a stored model is written when its turn comes.
BUILD = (
    "items", "magento_d_customerupdated", "inventory_qtyinventory", "int_magento_product_eav_lookups", "d_product", "int_item_costs",
    "int_fishbowl_order_cost", "int_sales_cost_fallback", "int_magento_order_freight", "int_shop_items", "f_sales", "int_receipt_lines",
    "f_pos", "f_shippment", "f_cohort", "f_cohort_detailed", "d_customer_segmentation", "int_daily_sales_by_caliber",
)
ANALYTICS = (
    "cdc_latest_order_lines", "cdc_latest_filter_first", "int_daily_sales_metrics", "f_forecast", "f_anomalies", "f_reorder_recommendations",
    "kpi_set", "sku_performance", "vq_revenue_by_caliber", "vq_top_states", "usage_cost_by_user", "usage_spikes", "previous_value_per_key",
    "top_n_per_key", "pivot_sum_kinds", "share_of_group", "anti_join_whole_orders",
)


def timed(frame_of) -> float:
    start = time.perf_counter()
    frame = frame_of()
    # All columns are computed; nothing is kept.
    frame.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").agg(F.count(F.lit(1))).collect()  # start the JVM's workers
    times: dict[str, float] = {}
    made = tables(spark, FOLDER)
    for name in BUILD:
        times["build_" + name] = timed(lambda: made[name])
    build = round(sum(times.values()), 3)
    for name in ANALYTICS:
        times[name] = timed(lambda: QUERIES[name].frame(spark, FOLDER))
    result = {
        "metric": "pipeline_build_and_analytics", "value": round(sum(times.values()), 3), "pipeline_build": build, "unit": "sec", "queries": times,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1], "models_built": len(BUILD),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
