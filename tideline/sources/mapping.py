"""Declared column mappings: source path to name and type."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import typing as ty

# Declared type names and the Spark types they stand for.
DECLARED_TYPES = {"string": "string", "integer": "bigint", "float": "double", "date": "date"}


@dataclass(frozen=True)
class ColumnSpec:
    """``path`` is a source column, dotted for nested data; ``derive`` computes one instead."""

    name: str
    type: str = "string"
    path: str | None = None
    derive: Callable[[], Column] | None = None
    format: str | None = None

    def column(self) -> Column:
        if self.derive is not None:
            return self.derive().alias(self.name)
        source = F.col(self.path or self.name)
        match self.type:
            case "string":
                typed = ty.null_if_marker(source.cast("string"))
            case "integer":
                typed = ty.try_long(source.cast("string"))
            case "float":
                typed = ty.clean_double(source.cast("string"))
            case "date":
                typed = F.try_to_date(source.cast("string"), self.format) if self.format else source.try_cast("date")
            case other:
                raise ValueError(f"unknown declared type {other!r}")
        return typed.alias(self.name)


def map_columns(df: DataFrame, specs: Sequence[ColumnSpec], keep: Sequence[str] = ()) -> DataFrame:
    """One projection over the source, so unused source columns are never read."""
    return df.select(*keep, *[spec.column() for spec in specs])


def declared_types(specs: Sequence[ColumnSpec]) -> dict[str, str]:
    """Spark type name of every declared column, for ``quality.schema_report``."""
    return {spec.name: DECLARED_TYPES[spec.type] for spec in specs}
