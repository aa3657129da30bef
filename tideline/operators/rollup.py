"""Daily rollups: aggregate to day grain first, then meet the calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily(
    facts: DataFrame, at: Column, measures: dict[str, Column], by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Measures per day of ``at`` and optional categories.

    Partial aggregation leaves at most one row per day, category and task for the
    shuffle, whatever the size of the facts or of a single day.
    """
    if where is not None:
        facts = facts.where(where)
    days = facts.where(at.isNotNull()).groupBy(F.to_date(at).alias("date"), *by)
    return days.agg(*[value.alias(name) for name, value in measures.items()])


def stages_daily(facts: DataFrame, stages: dict[str, Column], measures: dict[str, dict[str, Column]]) -> DataFrame:
    """Several daily rollups, each on its own event time, from a single scan.

    ``stages`` names the event times; ``measures[stage]`` are aggregates that see only
    rows of that stage, written with ``on_stage``.
    """
    events = F.array(*[F.struct(F.lit(n).alias("_stage"), F.to_date(at).alias("date")) for n, at in stages.items()])
    long = facts.select("*", F.inline(events).alias("_stage", "date")).where("date is not null")
    return long.groupBy("date").agg(
        *[value.alias(name) for stage in measures.values() for name, value in stage.items()]
    )


def stages_by_category(
    facts: DataFrame, stages: dict[str, Column], measures: dict[str, dict[str, Column]], categories: Sequence[str]
) -> DataFrame:
    """Daily rollups by each of several categories, one after the other, from a single scan and a single shuffle.

    Rows are ``kind`` (name of the category column), ``value`` (its value), ``stage`` and ``date`` with the measures
    of that stage; those of other stages see no row. Every fact becomes one narrow row per stage and
    category, which partial aggregation reduces before the shuffle.
    """
    events = F.array(*[F.struct(F.lit(n).alias("_stage"), F.to_date(at).alias("date")) for n, at in stages.items()])
    long = facts.select("*", F.inline(events).alias("_stage", "date")).where("date is not null")
    sets = [[F.col("date"), F.col("_stage"), F.col(c)] for c in categories]
    kind = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in categories])
    value = F.coalesce(*[F.when(F.grouping(c) == 0, F.col(c)) for c in categories])
    grouped = long.groupingSets(sets, "date", "_stage", *categories).agg(
        kind.alias("kind"),
        value.alias("value"),
        *[measure.alias(name) for stage in measures.values() for name, measure in stage.items()],
    )
    return grouped.withColumnRenamed("_stage", "stage").drop(*categories)


def on_stage(stage: str, value: Column, also: Column | None = None) -> Column:
    """``value`` on rows of ``stage`` (and where ``also`` holds), null elsewhere."""
    condition = F.col("_stage") == stage
    return F.when(condition if also is None else condition & also, value)


def on_spine(spine: DataFrame, rollup: DataFrame, zero: Sequence[str] = (), on: str = "date") -> DataFrame:
    """Every spine day with its rollup rows; measures named in ``zero`` are 0 where missing.

    Joining after the aggregation gives what joining the facts would: counts of a day
    without facts are zero, plain sums and means are null.
    """
    joined = spine.join(rollup, on, "left")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in zero}) if zero else joined


def chain(spine: DataFrame, rollups: Sequence[DataFrame], on: str = "date") -> DataFrame:
    """One-to-one left joins of several day-grain rollups to the spine."""
    for rollup in rollups:
        spine = spine.join(rollup, on, "left")
    return spine


def full_combine(
    spine: DataFrame, left: DataFrame, right: DataFrame, by: str, date: str = "date", coalesce_date: bool = False
) -> DataFrame:
    """Spine with ``left``, full-outer joined to ``right`` on the day and the category.

    Null categories never match, so each side keeps its own row for them. By default the
    date is the spine's alone: rows only ``right`` has carry a null date. With
    ``coalesce_date`` they carry the date of ``right``.
    """
    a = spine.join(left, date, "left").withColumnsRenamed({date: "_left_date", by: "_left_by"})
    b = right.withColumnsRenamed({date: "_right_date", by: "_right_by"})
    condition = (F.col("_left_date") == F.col("_right_date")) & (F.col("_left_by") == F.col("_right_by"))
    day = F.coalesce("_left_date", "_right_date") if coalesce_date else F.col("_left_date")
    measures = [n for n in [*left.columns, *right.columns] if n not in {date, by}]
    return a.join(b, condition, "full").select(
        day.alias(date), F.coalesce("_left_by", "_right_by").alias(by), *measures
    )
