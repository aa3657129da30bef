import random

from conftest import rows, ts
from pyspark.sql import functions as F

from tideline.functions import typing as ty
from tideline.operators import dedup


def test_first_per_key_keeps_one_null_key_and_orders_nulls_last(spark):
    frame = spark.createDataFrame(
        [(1, None, "x"), (1, 5, "y"), (1, 7, "z"), (None, 2, "p"), (None, 1, "q")], "k int, o int, v string"
    )
    kept = dedup.first_per_key(frame, ["k"], [F.asc_nulls_last("o")])
    assert sorted(rows(kept), key=repr) == sorted([(1, 5, "y"), (None, 1, "q")], key=repr)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") > 990).alias("k"), F.col("id").alias("o"))
    plan = dedup.first_per_key(frame, ["k"], [F.asc("o")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


SLICES = [
    # key, stage, loaded_at, review, issued, final, note
    (1, "review", "2024-01-01", "2024-01-01", None, None, "old"),
    (1, "issued", "2024-01-05", "nan", "2024-01-04", None, "mid"),
    (1, "review", "2024-01-09", None, None, None, "new"),
    (1, "final", "2024-01-08", None, None, "2024-01-07", "fin"),
    (2, "issued", "2024-01-02", None, "2024-01-02", None, "only"),
    (3, "review", "2024-01-02", None, None, "nan", None),
]


def merged(spark, slices):
    frame = spark.createDataFrame(
        [(k, s, ts(at), r, i, f, n) for k, s, at, r, i, f, n in slices],
        "k int, stage string, loaded_at timestamp_ntz, review string, issued string, final string, note string",
    )
    for name in ("review", "issued", "final"):
        frame = frame.withColumn(name, ty.null_if_marker(F.col(name)))
    out = dedup.latest_non_null(frame, ["k"], ["review", "issued", "final"], ["loaded_at", "stage"])
    return rows(out.select("k", "review", "issued", "final", "note"), "k")


def test_latest_non_null_never_erases(spark):
    assert merged(spark, SLICES) == [
        (1, "2024-01-01", "2024-01-04", "2024-01-07", "new"),
        (2, None, "2024-01-02", None, "only"),
        (3, None, None, None, None),
    ]


def test_latest_non_null_ignores_arrival_order_and_replays(spark):
    want = merged(spark, SLICES)
    for seed in range(3):
        shuffled = SLICES + SLICES[seed : seed + 2]
        random.Random(seed).shuffle(shuffled)
        assert merged(spark, shuffled) == want


def test_ties_fall_the_same_way(spark):
    frame = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "k int, o int, v string")
    assert rows(dedup.latest_non_null(frame, ["k"], ["v"], ["o"])) == [(1, 1, "b")]
    assert rows(dedup.latest_per_key(frame, ["k"], ["o"])) == [(1, 1, "b")]


def test_a_row_is_shuffled_once_and_not_beside_its_order(spark):
    frame = spark.createDataFrame([(1, "r", 2, "x"), (1, None, 3, "y"), (2, None, None, "z")], "k int, review string, at int, note string")
    out = dedup.latest_non_null(frame, ["k"], ["review"], ["at"])
    assert rows(out, "k") == [(1, "r", 3, "y"), (2, None, None, "z")]
    sent = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "partial_max" in line]
    assert sent and not any("max_by" in line or line.split("functions=")[0].count("note") > 1 for line in sent)
    # Columns of the order may be merged as well.
    assert rows(dedup.latest_non_null(frame, ["k"], ["review", "at"], ["at"]), "k") == [(1, "r", 3, "y"), (2, None, None, "z")]
