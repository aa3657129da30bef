from conftest import day, rows, ts
from pyspark.sql import functions as F

from tideline.operators import calendar, rollup


def spine(spark):
    return calendar.calendar_days(spark, "2024-01-01", "2024-01-04", years_ahead=0)


def facts(spark):
    return spark.createDataFrame(
        [
            ("a", ts("2024-01-01 10:00"), ts("2024-01-02"), 1.0),
            ("a", ts("2024-01-01 23:59"), None, None),
            ("b", ts("2024-01-03"), ts("2024-01-02"), 4.0),
            (None, ts("2024-01-03"), ts("2024-01-03"), 8.0),
            ("a", ts("2030-01-01"), None, 99.0),
        ],
        "k string, issued timestamp_ntz, review timestamp_ntz, v double",
    )


def test_aggregate_then_join_equals_join_then_aggregate(spark):
    daily = rollup.daily(facts(spark), F.col("issued"), {"n": F.count("v"), "total": F.sum("v"), "mean": F.avg("v")})
    got = rollup.on_spine(spine(spark), daily, zero=["n"])
    joined = spine(spark).join(facts(spark), F.col("date") == F.to_date("issued"), "left")
    want = joined.groupBy("date").agg(F.count("v").alias("n"), F.sum("v").alias("total"), F.avg("v").alias("mean"))
    assert rows(got, "date") == rows(want, "date")
    assert rows(got, "date")[1] == (day("2024-01-02"), 0, None, None)


def test_stages_from_one_scan_equal_separate_rollups(spark):
    def on(stage):
        return {f"n_{stage}": F.count(rollup.on_stage(stage, F.col("v"))), f"s_{stage}": F.sum(rollup.on_stage(stage, F.col("v")))}

    times = {"issued": F.col("issued"), "review": F.col("review")}
    one = rollup.stages_daily(facts(spark), times, {s: on(s) for s in times})
    got = rollup.on_spine(spine(spark), one, zero=["n_issued", "n_review"])
    parts = [
        rollup.on_spine(
            spine(spark),
            rollup.daily(facts(spark), at, {f"n_{s}": F.count("v"), f"s_{s}": F.sum("v")}),
            zero=[f"n_{s}"],
        )
        for s, at in times.items()
    ]
    assert rows(got, "date") == rows(rollup.chain(spine(spark), parts), "date")


def sides(spark):
    left = rollup.on_spine(spine(spark), rollup.daily(facts(spark), F.col("issued"), {"n_i": F.count("*")}, ["k"]), ["n_i"])
    right = rollup.on_spine(spine(spark), rollup.daily(facts(spark), F.col("review"), {"n_r": F.count("*")}, ["k"]), ["n_r"])
    return left, right


def test_full_combine_leaves_right_only_dates_null(spark):
    got = rows(rollup.full_combine(spine(spark), *sides(spark), by="k"))
    want = [
        (day("2024-01-01"), "a", 2, None),
        (day("2024-01-02"), None, 0, None),
        (day("2024-01-03"), "b", 1, None),
        (day("2024-01-03"), None, 1, None),
        (day("2024-01-04"), None, 0, None),
        (None, None, None, 0),  # 01-01 without reviews
        (None, "a", None, 1),
        (None, "b", None, 1),
        (None, None, None, 1),  # null categories never match
        (None, None, None, 0),
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_full_combine_can_coalesce_the_date(spark):
    got = rollup.full_combine(spine(spark), *sides(spark), by="k", coalesce_date=True)
    assert got.where("date is null").count() == 0 and got.count() == 10


def test_conjunct_keeps_spine_rows(spark):
    daily = rollup.daily(facts(spark), F.col("issued"), {"n": F.count("*")}, where=F.col("v") > 100)
    assert rollup.on_spine(spine(spark), daily, zero=["n"]).where("n = 0").count() == 4
