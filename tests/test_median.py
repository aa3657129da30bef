import random
import statistics

from conftest import rows
from pyspark.sql import functions as F

from tideline.operators.median import exact_medians
from tideline.operators.report import median_summary


def test_medians_of_skewed_groups_are_exact(spark):
    rng = random.Random(7)
    data = [("hot", float(rng.randrange(500)), rng.random()) for _ in range(3001)]
    data += [("even", float(v), None) for v in (1, 2, 3, 10)]
    data += [("one", 5.0, float("nan")), (None, 8.0, 2.0), (None, 9.0, None), ("none", None, None)]
    data += [("same", 4.0, 4.0)] * 50
    frame = spark.createDataFrame(data, "k string, a double, b double").repartition(5)
    got = {r.k: (r.a, r.b) for r in exact_medians(frame, ["k"], {"a": F.col("a"), "b": F.col("b")}).collect()}

    def middle(k, i):
        present = [row[i] for row in data if row[0] == k and row[i] is not None and row[i] == row[i]]
        return statistics.median(present) if present else None

    assert got == {k: (middle(k, 1), middle(k, 2)) for k in ("hot", "even", "one", None, "same")}


def test_summary_keeps_groups_without_values(spark):
    frame = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", None), (None, 7.0)], "k string, v double")
    out = median_summary(frame, "k", "n", {"m": F.col("v")}, [F.desc_nulls_last("m")])
    assert rows(out) == [(None, 1, 7.0), ("x", 2, 2.0), ("y", 1, None)]
