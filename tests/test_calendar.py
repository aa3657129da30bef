import random

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from tideline.operators import calendar


def test_calendar_has_both_ends_and_leap_days(spark):
    days = [r[0] for r in calendar.calendar_days(spark, "2023-12-30", "2024-02-29").orderBy("date").collect()]
    assert days[0] == day("2023-12-30") and days[-1] == day("2025-02-28")
    assert day("2024-02-29") in days and len(days) == len(set(days)) == 427


def test_empty_series_when_end_is_before_start(spark):
    assert calendar.calendar_days(spark, "2024-01-02", "2024-01-01", years_ahead=0).count() == 0


def test_slice_grid_restricted_and_capped(spark):
    args = {"step_days": 1, "window_days": 1, "categories": {"stage": ["a", "b", "c"]}}
    grid = calendar.slice_grid(spark, "2024-01-01", "2024-01-10", **args)
    assert grid.count() == 30 and grid.where("slice_start <> slice_end").count() == 0
    part = calendar.slice_grid(spark, "2024-01-01", "2024-01-10", only_from="2024-01-03", only_to="2024-01-04", **args)
    assert part.count() == 6
    first = calendar.slice_grid(spark, "2024-01-01", "2024-01-10", limit=1, **args)
    assert rows(first) == [(day("2024-01-01"), day("2024-01-01"), "a")]
    weekly = calendar.slice_grid(spark, "2024-01-01", "2024-01-31", step_days=7, window_days=7)
    assert rows(weekly, "slice_start")[1] == (day("2024-01-08"), day("2024-01-14"))


def test_request_text(spark):
    grid = calendar.slice_grid(spark, "2024-01-05", "2024-01-05")
    assert rows(grid.select(calendar.request_text(F.col("slice_start")))) == [("01/05/2024",)]


@pytest.mark.parametrize("n", [3, 1500])
def test_cap_keeps_the_first_rows_of_every_slice(spark, n):
    values = list(range(4000))
    random.Random(1).shuffle(values)
    frame = spark.createDataFrame([("hot" if v % 4 else "cold", v) for v in values], "s string, v int")
    capped = calendar.cap_per_slice(frame, ["s"], ["v"], n)
    got = {s: sorted(r.v for r in capped.where(F.col("s") == s).collect()) for s in ("hot", "cold")}
    want = {
        s: sorted(v for v in values if (v % 4 != 0) == (s == "hot"))[:n] for s in ("hot", "cold")
    }
    assert got == want


def test_dense_grid_is_days_times_categories(spark):
    facts = spark.createDataFrame(
        [(day("2024-01-01"), "a", 1), (day("2024-01-03"), "b", 2), (None, "c", 3), (day("2024-01-04"), None, 4)],
        "date date, k string, v int",
    )
    dense = calendar.densify(facts, "k")
    assert dense.count() == 9
    assert dense.where("v is not null").count() == 2
    assert calendar.densify(facts, "k", after="2024-01-01").count() == 6


def test_missing_runs(spark):
    grid = calendar.slice_grid(spark, "2024-01-01", "2024-01-10", categories={"kind": ["a", "b", "c"]})
    landed = spark.createDataFrame(
        [("a", day("2024-01-03")), ("a", day("2024-01-03")), ("a", day("2024-01-10")), ("a", day("2023-12-31")), ("x", day("2024-01-01")),
         *[("b", day(f"2024-01-{d:02d}")) for d in range(1, 11)]], "kind string, slice_start date")
    got = rows(calendar.missing_runs(grid, landed, ["kind"]), "kind", "first_missing")
    assert got == [
        ("a", day("2024-01-01"), day("2024-01-02"), 2), ("a", day("2024-01-04"), day("2024-01-09"), 6), ("c", day("2024-01-01"), day("2024-01-10"), 10)
    ]
    weekly = calendar.slice_grid(spark, "2024-01-01", "2024-02-01", step_days=7, window_days=7)
    seen = spark.createDataFrame([(day("2024-01-15"),)], "slice_start date")
    got = rows(calendar.missing_runs(weekly, seen, step_days=7), "first_missing")
    assert got == [(day("2024-01-01"), day("2024-01-08"), 2), (day("2024-01-22"), day("2024-01-29"), 2)]
