import datetime as dt
import random

import pytest
from conftest import day, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import rolling

START = dt.date(2020, 1, 1)


def series(spark, n=420):
    rng = random.Random(3)
    data = [(START + dt.timedelta(i), rng.choice([None, float(rng.randrange(100))])) for i in range(n)]
    return data, spark.createDataFrame(data, "date date, v double")


def test_trailing_series_matches_brute_force(spark):
    data, frame = series(spark)
    out = rolling.trailing_series(
        frame, {"mean": F.avg("v"), "n": F.count("v")}, "2020-01-03", "2020-01-05", rows=366
    )
    fed = [(d, v) for d, v in data if d > day("2020-01-03")]
    want = []
    for i, (d, _) in enumerate(fed):
        if d > day("2020-01-05"):
            present = [v for _, v in fed[max(0, i - 365) : i + 1] if v is not None]
            want.append((d, sum(present) / len(present) if present else None, len(present)))
    assert rows(out) == want  # sorted by day already


def test_category_mean_counts_missing_days_as_zero(spark):
    frame = spark.createDataFrame(
        [(day("2020-01-02"), "a", 4.0), (day("2020-01-03"), "b", 6.0), (day("2020-01-04"), "a", None),
         (None, "c", 1.0), (day("2020-01-05"), None, 7.0)],
        "date date, k string, v double",
    )
    out = rolling.trailing_by_category(frame, "k", "v", "2020-01-01", "2020-01-03", rows=2)
    assert rows(out) == [
        (day("2020-01-04"), "a", 0.0),
        (day("2020-01-05"), "a", 0.0),
        (day("2020-01-04"), "b", 3.0),
        (day("2020-01-05"), "b", 0.0),
        (day("2020-01-04"), "c", 0.0),
        (day("2020-01-05"), "c", 0.0),
    ]


@pytest.mark.parametrize(("n", "frame", "block"), [(0, 5, 10), (1, 5, 10), (1000, 1, 7), (1000, 7, 7), (1000, 30, 10), (1000, 366, 400)])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_blocks_equal_the_plain_window(spark, n, frame, block, by):
    # Two thirds of the rows hold one category, times repeat and some are null.
    source = spark.range(n).selectExpr(
        "id", "if(id % 7 = 0, null, (id * 37) % 50) t", "if(id % 3 = 0, id % 5, -1) k", "if(id % 4 = 0, null, id) v"
    )
    measures = {"total": F.sum("v"), "least": F.min("v"), "n": F.count("*")}
    order = [F.asc_nulls_last("t"), F.asc_nulls_last("id")]
    plain = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(frame - 1), 0)
    want = source.select("*", *[value.over(plain).alias(name) for name, value in measures.items()])
    got = rolling.trailing_in_blocks(source, ["t", "id"], measures, frame, by, block)
    assert rows(got, "id") == rows(want, "id")


def test_no_block_holds_more_than_its_rows_and_the_lead_in(spark):
    source = spark.range(5000).selectExpr("id", "1 as k")
    seen = rolling.trailing_in_blocks(source, ["id"], {"first_seen": F.min("id"), "n": F.count("*")}, 4000, ["k"], 100)
    assert seen.agg(F.max("n")).first()[0] == 4000
    numbered = rolling.numbered_in_order(source, ["id"])
    assert numbered.where("id <> _position").isEmpty() and numbered.count() == 5000
