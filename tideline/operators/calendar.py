"""Calendars, slice grids and dense date-by-category grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions.dates import AsOf, day


def day_series(start: AsOf, end: AsOf, step_days: int = 1) -> Column:
    """Array of dates, both ends included; empty when end is before start."""
    first, last = day(start), day(end)
    return F.when(first <= last, F.sequence(first, last, F.expr(f"interval {int(step_days)} day"))).otherwise(
        F.array().cast("array<date>")
    )


def calendar_days(spark: SparkSession, start: AsOf, as_of: AsOf = None, years_ahead: int = 1) -> DataFrame:
    """One row per day from ``start`` to ``years_ahead`` years after ``as_of``.

    Bounds may be scalar subqueries over a table (``df.agg(...).scalar()``).
    """
    end = F.add_months(day(as_of), 12 * years_ahead)
    return spark.range(1).select(F.explode(day_series(start, end)).alias("date"))


def slice_grid(
    spark: SparkSession,
    start: AsOf,
    end: AsOf,
    step_days: int = 1,
    window_days: int = 1,
    categories: dict[str, Sequence[str]] | None = None,
    only_from: AsOf = None,
    only_to: AsOf = None,
    limit: int | None = None,
) -> DataFrame:
    """All slices of a declared iteration: date range times every categorical parameter.

    ``only_from`` and ``only_to`` restrict a run to part of the declared range; ``limit``
    keeps the first slices. Each slice covers ``window_days`` days from ``slice_start``.
    """
    grid = spark.range(1).select(F.explode(day_series(start, end, step_days)).alias("slice_start"))
    if only_from is not None:
        grid = grid.where(F.col("slice_start") >= day(only_from))
    if only_to is not None:
        grid = grid.where(F.col("slice_start") <= day(only_to))
    grid = grid.withColumn("slice_end", F.date_add("slice_start", window_days - 1))
    for name, values in (categories or {}).items():
        grid = grid.select("*", F.explode(F.lit(list(values))).alias(name))
    if limit is not None:
        grid = grid.orderBy("slice_start", *(categories or {})).limit(limit)
    return grid


def category_slices(
    domain: DataFrame, category: str, start: AsOf, end: AsOf, step_days: int = 1, window_days: int = 1
) -> DataFrame:
    """Slice grid whose categorical values are the distinct values of a table column."""
    values = domain.select(category).distinct()
    grid = values.select(category, F.explode(day_series(start, end, step_days)).alias("slice_start"))
    return grid.withColumn("slice_end", F.date_add("slice_start", window_days - 1))


def missing_runs(grid: DataFrame, landed: DataFrame, by: Sequence[str] = (), step_days: int = 1) -> DataFrame:
    """Runs of successive slices of the grid that nothing has landed for, per category: first and last start, and length.

    ``landed`` has ``slice_start`` and the categories, any number of rows a slice. Within a category a missing
    slice's start less its number in order is the same all along a run. Windows only see slices of the
    grid, which the calendar bounds for each category.
    """
    on = [*by, "slice_start"]
    missing = grid.join(landed.select(*on).distinct(), on, "left_anti")
    number = F.row_number().over(Window.partitionBy(*by).orderBy("slice_start"))
    runs = missing.withColumn("_run", F.date_sub("slice_start", (number * step_days).cast("int")))
    return runs.groupBy(*by, "_run").agg(
        F.min("slice_start").alias("first_missing"), F.max("slice_start").alias("last_missing"), F.count("*").alias("n_missing")
    ).drop("_run")


def request_text(date: Column, pattern: str = "MM/dd/yyyy") -> Column:
    """Date as the text a request parameter carries."""
    return F.date_format(date, pattern)


def cap_per_slice(
    df: DataFrame, slice_columns: Sequence[str], order_by: Sequence[str], n: int, salts: int = 64
) -> DataFrame:
    """First ``n`` rows of every slice in a total order.

    The cap is applied first to ``salts`` parts of each slice, so that no task ever sorts
    a whole hot slice, and then to the at most ``salts * n`` survivors. The plan is the
    same for every ``n``.
    """
    order = [F.asc_nulls_last(name) for name in order_by]

    def first_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return ranked.where(F.col("_rank") <= n).drop("_rank")

    salt = F.pmod(F.xxhash64(*order_by), F.lit(salts))
    parts = first_rows(df.withColumn("_salt", salt), [*slice_columns, "_salt"]).drop("_salt")
    return first_rows(parts, slice_columns)


def dense_grid(facts: DataFrame, by: str, date: str = "date", after: AsOf = None) -> DataFrame:
    """Every distinct date with every distinct non-null category.

    The dates form one array, bounded by the calendar; each category row explodes it,
    so no join pairs the two domains.
    """
    dated = facts.where(F.col(date).isNotNull())
    if after is not None:
        dated = dated.where(F.col(date) > day(after))
    dates = dated.agg(F.array_sort(F.collect_set(date))).scalar()
    categories = facts.where(F.col(by).isNotNull()).select(by).distinct()
    return categories.select(F.explode(dates).alias(date), by)


def densify(facts: DataFrame, by: str, date: str = "date", after: AsOf = None) -> DataFrame:
    """``facts`` on the dense grid; grid cells without a fact have null measures.

    ``facts`` is read for its dates, its categories and its values, so pass a stored rollup.
    """
    return dense_grid(facts, by, date, after).join(facts, [date, by], "left")
