"""Named queries: a Spark callable, the matching DuckDB statement, rounding."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from stocktally.sources.tables import Tables
from workload.oracle_models import assemble, rounded
from workload.tables import tables


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None
    digits: dict[str, int]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(self.run(tables(spark, sf_dir)), self.digits)

    def statement(self) -> str | None:
        return None if self.sql is None else assemble(rounded(self.sql, self.digits))


QUERIES: dict[str, Query] = {}


def add(name: str, run: Callable[[Tables], DataFrame], sql: str | None, digits: str | dict[str, int] = "") -> None:
    """Register a query. digits is a mapping, or names separated by blanks (4 places)."""
    if name in QUERIES:
        raise ValueError(f"query {name!r} is registered twice")
    places = digits if isinstance(digits, dict) else {c: 4 for c in digits.split()}
    QUERIES[name] = Query(name, run, sql, places)


def finish(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round fractional columns and turn decimals into doubles.

    The engines break exact ties differently, so values are first moved away from
    zero by a thousandth of the last kept place.
    """
    def places(name: str, d: int):
        value = F.col(name).cast("double")
        return F.round(value + F.signum(value) * float(f"1e-{d + 3}"), d)

    changes = {c: places(c, d) for c, d in digits.items()}
    for field in df.schema.fields:
        if field.name not in changes and isinstance(field.dataType, T.DecimalType):
            changes[field.name] = F.col(field.name).cast("double")
    return df.withColumns(changes) if changes else df
