"""Exact medians per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import written

#: Different values in one part, on average; the middle part of a group is ranked in one task.
PART_ROWS = 1 << 18


def exact_medians(df: DataFrame, by: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Median of each value per group; nulls and NaN are left out.

    Equal values are first counted, which combines before the shuffle. The counts are
    range-partitioned by group and value, so a hot group spreads over many parts, each
    an interval of its values. Summing the parts tells which one holds the middle rank,
    and only that part is ranked value by value. The ranged counts are written once,
    because both passes must see the same part borders.
    """
    measures = F.array(*[F.struct(F.lit(n).alias("_m"), v.cast("double").alias("_v")) for n, v in values.items()])
    long = df.select(*by, F.inline(measures).alias("_m", "_v")).where("_v is not null and not isnan(_v)")
    group = [*by, "_m"]
    # Written first: finding the range borders samples the counts, which would read the source again.
    counts = written(long.groupBy(*group, "_v").agg(F.count("*").alias("_n")), "median-counts")
    n_parts = counts.count() // PART_ROWS + 1
    parts = written(
        counts.repartitionByRange(n_parts, *group, "_v").withColumn("_part", F.spark_partition_id()), "median-parts"
    )

    across = Window.partitionBy(*group).orderBy("_part")
    sums = parts.groupBy(*group, "_part").agg(F.sum("_n").alias("_in_part"))
    sums = sums.select(
        *group,
        "_part",
        (F.sum("_in_part").over(across) - F.col("_in_part")).alias("_before"),
        F.sum("_in_part").over(across).alias("_upto_part"),
        F.sum("_in_part").over(Window.partitionBy(*group)).alias("_total"),
    )
    # One-based ranks of the middle; the same rank twice when the total is odd.
    low, high = F.expr("(_total + 1) div 2"), F.expr("(_total + 2) div 2")
    middle = sums.where((F.col("_before") < high) & (F.col("_upto_part") >= low))
    middle = middle.select(*group, "_part", "_before", low.alias("_low"), high.alias("_high"))

    same = [F.col(f"p.{name}").eqNullSafe(F.col(f"m.{name}")) for name in [*group, "_part"]]
    inside = parts.alias("p").join(middle.alias("m"), reduce(lambda a, b: a & b, same))
    inside = inside.select("p.*", "_before", "_low", "_high")
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*group, "_part").orderBy("_v"))
    ranked = inside.withColumn("_upto", upto)

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_n") < F.col(rank)), F.col("_v")))

    medians = ranked.groupBy(*group).agg(((at("_low") + at("_high")) / 2).alias("_median"))
    return medians.groupBy(*by).agg(
        *[F.max(F.when(F.col("_m") == name, F.col("_median"))).alias(name) for name in values]
    )
