"""Key checks, counts made while a dataset is written, and conformity to a declared schema. Empty checks mean passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows; null keys are no duplicates."""
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def _lacks(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that lack part of the key."""
    return df.where(_lacks(keys))


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``n_rows``, ``n_null_keys`` rows that lack part of the key, ``n_repeated_keys`` held by several rows.

    Copies of a key are counted where they are read first, so a hot key costs one row a task.
    """
    lacks = F.max(_lacks(keys))
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"), lacks.alias("lacks"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("lacks"), F.col("n")).otherwise(0)), F.lit(0)).alias("n_null_keys"),
        F.count_if(~F.col("lacks") & (F.col("n") > 1)).alias("n_repeated_keys"),
    )


def watched(df: DataFrame, rows: str = "n_rows", **tests: Column) -> tuple[DataFrame, Observation]:
    """``df``, and what the first job over it counts in passing: all rows as ``rows``, and those that pass each test.

    The counts cost no scan of their own. Behind a job's last shuffle they are exact; before it, a task
    that runs again because an executor was lost with its output counts again. Reading ``get`` waits for a job.
    """
    watch = Observation()
    return df.observe(watch, F.count(F.lit(1)).alias(rows), *[F.count_if(t).alias(n) for n, t in tests.items()]), watch


def watched_keys(df: DataFrame, keys: Sequence[str], rows: str = "n_rows") -> tuple[DataFrame, Observation]:
    """As :func:`watched`, with ``n_null_keys``, the rows that lack part of the key."""
    return watched(df, rows, n_null_keys=_lacks(keys))


def schema_report(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """One row per declared or present column: status, found and declared type, row and null counts.

    Status is ``ok``, ``mistyped``, ``missing`` or ``extra``. All counts come from one scan.
    """
    found = {field.name: field.dataType.simpleString() for field in df.schema}
    names = [*declared, *[name for name in found if name not in declared]]

    def status(name: str) -> str:
        if name not in found:
            return "missing"
        if name not in declared:
            return "extra"
        return "ok" if found[name] == declared[name] else "mistyped"

    totals = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(name).alias(f"_filled_{i}") for i, name in enumerate(names) if name in found],
    )
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(status(name)).alias("status"),
            F.lit(declared.get(name)).cast("string").alias("declared_type"),
            F.lit(found.get(name)).cast("string").alias("found_type"),
            F.col("_rows").alias("n_rows"),
            (F.col("_rows") - F.col(f"_filled_{i}") if name in found else F.lit(None).cast("bigint")).alias("n_null"),
        )
        for i, name in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*entries)))
