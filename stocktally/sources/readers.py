"""Reading landing tables, invoices, seeds and date-laid change files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stocktally.sources.silver import LANDING

INVOICE_SCHEMA = "tracking_number string, net_amount decimal(18,4)"
CUSTOMER_GROUP_SCHEMA = "customer_group_id int, customer_group_code string"


def read_source(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A landing table ``system.table``: from parquet below root, else from the catalog."""
    system, table = name.split(".", 1)
    if root is None:
        return spark.table(f"{system}.{table}")
    return spark.read.parquet(f"{root.rstrip('/')}/{system}/{table}")


def read_landing(spark: SparkSession, root: str | None = None, names: list[str] | None = None) -> dict[str, DataFrame]:
    """All landing tables, or the named ones."""
    wanted = names or sorted({f"{system}.{table}" for system, table in LANDING.values()})
    return {name: read_source(spark, name, root) for name in wanted}


def read_invoices(spark: SparkSession, path: str) -> DataFrame:
    """Carrier invoices uploaded as CSV; many lines per tracking number."""
    return spark.read.csv(path, header=True, schema=INVOICE_SCHEMA)


def read_seed(spark: SparkSession, path: str, schema: str = CUSTOMER_GROUP_SCHEMA) -> DataFrame:
    """A small lookup file. Joins pick a broadcast from its file size."""
    return spark.read.csv(path, header=True, schema=schema)


def read_cdc_files(spark: SparkSession, glob: str, schema=None) -> DataFrame:
    """Change files laid out by date, through a path pattern."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(glob)


def stream_cdc_files(spark: SparkSession, folder: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """The same files as a stream of newly arriving ones."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def driver_tables(spark: SparkSession, folder: str, names: tuple[str, ...]) -> Mapping[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
