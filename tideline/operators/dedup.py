"""Keyed deduplication: one row per key, or one row assembled from several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key; null keys form one group of their own.

    The rank filter is kept in its plain form: Spark then reduces every key to one row
    per task before the shuffle, so a hot key costs no more than any other.
    ``order_by`` should be total, otherwise ties fall as they may.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` of each key; other columns break ties."""
    rest = [name for name in df.columns if name not in {*keys, *order_by}]
    comparable = [f.name for f in df.schema if f.name in rest and f.dataType.typeName() != "map"]
    return first_per_key(df, keys, [F.desc_nulls_last(name) for name in [*order_by, *comparable]])


def latest_non_null(
    df: DataFrame, keys: Sequence[str], merge_columns: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """One row per key: each merge column holds its latest non-null value.

    The remaining columns come together from the latest row. It is one aggregation with
    a partial result per task, so copies of a hot key are combined before the shuffle.
    Values tied on ``order_by`` are decided by the greater value, so that the result does
    not depend on arrival order.
    """
    rest = [name for name in df.columns if name not in {*keys, *merge_columns}]
    at = {name: f"_at{i}" for i, name in enumerate(order_by)}
    moment = [F.col(name).alias(place) for name, place in at.items()]

    def latest(name: str) -> Column:
        value = F.col(name)
        return F.max(F.when(value.isNotNull(), F.struct(*moment, value.alias("_value"))))["_value"]

    merged = [latest(name).alias(name) for name in merge_columns]
    if rest:  # the greatest of structs, so that a row is shuffled once and not beside its order
        merged.append(F.max(F.struct(*moment, *[F.col(n) for n in rest if n not in at])).alias("_row"))
    grouped = df.groupBy(*keys).agg(*merged)
    picked = {name: F.col(f"_row.{at.get(name, name)}").alias(name) for name in rest}
    return grouped.select(*[picked.get(name, F.col(name)) for name in df.columns])
