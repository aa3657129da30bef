"""Reports: recent window, top groups, counts and medians by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.dates import AsOf, day
from tideline.operators.median import exact_medians


def within_days(at: Column, as_of: AsOf = None, days_back: int = 7) -> Column:
    """The day of ``at`` is one of the ``days_back`` days before ``as_of`` or as_of itself.

    Spark turns the test on the day into timestamp bounds that reach the scan.
    """
    last = day(as_of)
    return F.to_date(at).between(F.date_sub(last, days_back), last)


def group_summary(
    df: DataFrame,
    by: Sequence[str | Column],
    measures: dict[str, Column],
    order_by: Sequence[Column],
    limit: int | None = None,
) -> DataFrame:
    """Aggregates per group in report order, optionally only the first groups."""
    summary = df.groupBy(*by).agg(*[value.alias(name) for name, value in measures.items()]).orderBy(*order_by)
    return summary if limit is None else summary.limit(limit)


def median_summary(
    df: DataFrame, by: str, count_name: str, medians: dict[str, Column], order_by: Sequence[Column]
) -> DataFrame:
    """Row count and exact medians per group. Groups without any value keep null medians."""
    counts = df.groupBy(by).agg(F.count("*").alias(count_name))
    middle = exact_medians(df, [by], medians)
    joined = counts.alias("c").join(middle.alias("m"), F.col(f"c.{by}").eqNullSafe(F.col(f"m.{by}")), "left")
    return joined.select(f"c.{by}", count_name, *medians).orderBy(*order_by)
