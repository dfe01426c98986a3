"""Data-quality expectations. Each returns the rows that break it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from stocktally.operators.windows import decreasing_steps

# Fixed value: the postcode pattern used by the existing checks.
ZIP_PATTERN = r"^[0-9]{5}-?[0-9]{3}$"
EMAIL_LIKE = "%_@__%.__%"

Check = Callable[..., Column]


def _col(c: str) -> Column:
    return F.col(c)


# Row-level rules: True marks a violation. NULL values pass unless the rule is about NULLs.
RULES: dict[str, Check] = {
    "match_regex": lambda c, pattern: ~_col(c).rlike(pattern),
    "date_range": lambda c, start, end: (_col(c) < F.lit(start).cast("date")) | (_col(c) > F.lit(end).cast("date")),
    "non_negative": lambda c: _col(c) < 0,
    "numeric_range": lambda c, low, high: (_col(c) < low) | (_col(c) > high),
    "recent_update": lambda c, days, as_of: _col(c) < F.date_sub(F.lit(as_of).cast("date"), days),
    "valid_date": lambda c: _col(c).cast("string").try_cast("date").isNull(),
    "valid_email": lambda c: ~_col(c).like(EMAIL_LIKE),
    "valid_zip": lambda c: ~_col(c).rlike(ZIP_PATTERN),
    "max_length": lambda c, limit: F.length(c) > limit,
    "min_length": lambda c, limit: F.length(c) < limit,
    "no_future_dates": lambda c, as_of: _col(c) > F.lit(as_of).cast("date"),
    "no_past_dates": lambda c, as_of: _col(c) < F.lit(as_of).cast("date"),
    "not_null": lambda c: _col(c).isNull(),
    "no_special_characters": lambda c: _col(c).rlike(r"[^a-zA-Z0-9\s]"),
    "values_in_list": lambda c, values: ~_col(c).isin(list(values)),
}


def _unique(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _relationship(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    known = to.select(F.col(field).alias("__known")).distinct()
    return df.filter(F.col(column).isNotNull()).join(known, F.col(column) == F.col("__known"), "left_anti")


TABLE_RULES: dict[str, Callable[..., DataFrame]] = {
    "unique": _unique,
    "relationships": _relationship,
    "increasing_over_time": lambda df, column, date_column, tiebreak=(): decreasing_steps(df, column, date_column, tiebreak),
}


def expect(df: DataFrame, rule: str, column: str, **args) -> DataFrame:
    """Rows (or keys) of df that violate a rule."""
    if rule in TABLE_RULES:
        return TABLE_RULES[rule](df, column, **args)
    return df.filter(RULES[rule](column, **args))


@dataclass(frozen=True)
class Expectation:
    rule: str
    column: str
    args: tuple[tuple[str, object], ...] = ()
    severity: str = "warn"


def report(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Violations per expectation in one scan of the table.

    Row-level rules only; table rules go through expect().
    """
    counts = df.agg(*[
        F.count_if(RULES[e.rule](e.column, **dict(e.args))).alias(f"c{i}") for i, e in enumerate(expectations)
    ])
    rows = F.array(*[
        F.struct(F.lit(e.rule).alias("rule"), F.lit(e.column).alias("column_name"), F.lit(e.severity).alias("severity"),
                 F.col(f"c{i}").alias("violations"))
        for i, e in enumerate(expectations)
    ])
    result = counts.select(F.explode(rows).alias("r")).select("r.*")
    passed = F.col("violations") == 0
    return result.withColumn("status", F.when(passed, "pass").otherwise(F.col("severity")))


@dataclass(frozen=True)
class Finding:
    """What a write has counted for an expectation."""

    expectation: Expectation
    violations: int

    @property
    def status(self) -> str:
        return "pass" if self.violations == 0 else self.expectation.severity


class ExpectationFailed(ValueError):
    """Expectations of severity error that the rows of a write have broken."""

    def __init__(self, where: str, broken: Sequence[Finding]):
        self.broken = list(broken)
        said = ", ".join(f"{f.expectation.rule}({f.expectation.column}): {f.violations} rows" for f in broken)
        super().__init__(f"{where} was not committed: {said}")


def observed(df: DataFrame, checks: Sequence[Expectation]) -> tuple[DataFrame, Callable[[], list[Finding]]]:
    """df that counts violations while a job reads it, and what gives the counts after that job.

    Row-level rules only: they need no scan and no shuffle of their own.
    """
    table_rules = [c.rule for c in checks if c.rule not in RULES]
    if table_rules:
        raise ValueError(f"not a row-level rule: {table_rules}")
    if not checks:
        return df, list
    seen = Observation()
    counts = [F.coalesce(F.count_if(RULES[c.rule](c.column, **dict(c.args))), F.lit(0)).alias(f"c{i}") for i, c in enumerate(checks)]
    return df.observe(seen, *counts), lambda: [Finding(c, int(seen.get.get(f"c{i}") or 0)) for i, c in enumerate(checks)]
