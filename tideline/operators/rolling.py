"""Trailing averages and sums over day-grain series, and in blocks over series of any grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tideline.functions.dates import AsOf, day
from tideline.operators.calendar import densify
from tideline.session import written


def trailing(rows: int = 366, by: Sequence[str] = (), date: str = "date") -> WindowSpec:
    """The current day and the ``rows - 1`` rows before it.

    Without ``by`` all rows meet in one task, so this is for day-grain input only, whose
    size the calendar bounds; ``trailing_in_blocks`` takes any.
    """
    return Window.partitionBy(*by).orderBy(F.asc_nulls_last(date)).rowsBetween(-(rows - 1), 0)


def trailing_series(
    by_day: DataFrame, measures: dict[str, Column], warmup_from: AsOf, report_from: AsOf, rows: int = 366
) -> DataFrame:
    """Trailing aggregates over the whole day series, sorted by day.

    Days after ``warmup_from`` feed the window and days after ``report_from`` are kept, so
    that the first reported frames are full. ``measures`` are unwindowed aggregates; their
    nulls are skipped, which makes a mean one over the days that have a value.
    """
    window = trailing(rows)
    return (
        by_day.where(F.col("date") > day(warmup_from))
        .select("date", *[value.over(window).alias(name) for name, value in measures.items()])
        .where(F.col("date") > day(report_from))
        .orderBy("date")
    )


def trailing_by_category(
    by_day: DataFrame,
    by: str,
    measure: str,
    warmup_from: AsOf,
    report_from: AsOf,
    rows: int = 366,
    value_name: str = "value",
    category_name: str = "type",
) -> DataFrame:
    """Trailing mean per category on the dense grid; missing days count as zero."""
    facts = by_day.select("date", by, measure)
    dense = densify(facts, by, after=warmup_from)
    mean = F.avg(F.coalesce(F.col(measure), F.lit(0))).over(trailing(rows, [by]))
    return (
        dense.select("date", F.col(by).alias(category_name), mean.alias(value_name))
        .where(F.col("date") > day(report_from))
        .orderBy(F.asc_nulls_last(category_name), F.asc_nulls_last("date"))
    )


def numbered_in_order(df: DataFrame, order_by: Sequence[str], position: str = "_position") -> DataFrame:
    """``df`` with the position of each row, from 0, in the order of ``order_by`` (nulls last), which must be total.

    Rows are dealt by ranges of the order and written once, so that a lost task cannot deal them anew in other ranges.
    Within a range they are numbered by a window; the sizes of the ranges, one row each, are added up in one task.
    """
    order = [F.asc_nulls_last(name) for name in order_by]
    dealt = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size"))
    sizes = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = dealt.withColumn("_number", number).join(sizes, "_range")
    return numbered.withColumn(position, F.col("_before") + F.col("_number") - 1).drop("_range", "_before", "_number")


def trailing_in_blocks(
    df: DataFrame,
    order_by: Sequence[str],
    measures: dict[str, Column],
    rows: int = 366,
    by: Sequence[str] = (),
    block_rows: int = 100_000,
) -> DataFrame:
    """``df`` with aggregates over each row and the ``rows - 1`` before it (of the same ``by``), for any number of rows.

    All rows are numbered in the order of ``by`` and ``order_by`` and cut into blocks of equal size. The
    last ``rows - 1`` of a block go to the next one too, where they only fill frames. So no task gets more than a block and
    its lead-in, however many rows a category holds, and the result is that of the plain window. ``order_by`` must
    be total within a category; ties are in no defined order, as with the plain window.
    """
    block_rows = max(block_rows, rows)
    numbered = numbered_in_order(df, [*by, *order_by])
    block = F.floor(F.col("_position") / block_rows)
    leads_in = F.col("_position") % block_rows > block_rows - rows
    blocks = F.when(leads_in, F.array(block, block + 1)).otherwise(F.array(block))
    dealt = numbered.withColumn("_home", block).withColumn("_block", F.explode(blocks))
    frame = Window.partitionBy(*by, "_block").orderBy("_position").rowsBetween(-(rows - 1), 0)
    framed = dealt.select("*", *[value.over(frame).alias(name) for name, value in measures.items()])
    return framed.where("_block = _home").drop("_position", "_home", "_block")
