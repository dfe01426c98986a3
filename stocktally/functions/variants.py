"""JSON text parsed once: variants, typed paths out of them, and shredded columns for storage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

PATHS = Mapping[str, tuple[str, str]]  # column: path, type


def parsed(text: str | Column) -> Column:
    """The text as a variant; null where it is no JSON."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def path_of(variant: str, path: str, kind: str) -> Column:
    """The value at a path as a type; null where the path is missing or the value does not fit."""
    return F.try_variant_get(F.col(variant), path, kind)


def shred(df: DataFrame, text: str, paths: PATHS, variant: str = "variant") -> DataFrame:
    """df with the JSON column parsed once: typed columns for the named paths, and the whole as a variant.

    Stored like this, readers of a named path scan one typed column, with its statistics; other paths are read from the
    variant without parsing text again. The text column goes.
    """
    held = df.withColumn(variant, parsed(text))
    return held.withColumns({name: path_of(variant, path, kind) for name, (path, kind) in paths.items()}).drop(text)
