"""Rows of dropped keys and rows of large groups told by bitmaps (``operators.bitmaps``), to spare texts a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.bitmaps import bitmap, marked


def without(df: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``dropped``; only suspects are shuffled. Null keys stay."""
    dropped = dropped.select(F.col(f"`{key}`").alias("_bm_drop")).distinct()
    held = marked(df, bitmap(dropped), [F.col(f"`{key}`")], "_bm_maybe")
    free = held.filter(~F.col("_bm_maybe"))
    suspects = held.filter("_bm_maybe")
    suspects = suspects.join(dropped, suspects[f"`{key}`"] == F.col("_bm_drop"), "left_anti")
    return free.unionByName(suspects).select(*[f"`{c}`" for c in df.columns])


HOT_ROWS = 1000
SALTS = 64


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, spread: Column) -> DataFrame:
    """Left join of ``rows`` to ``groups``, one row a key, where a key may hold any share of the rows.

    Groups of more than ``HOT_ROWS`` rows, told on both sides by one bitmap, are repeated ``SALTS``
    times and their rows dealt over the copies by ``spread``.
    """
    hot = bitmap(groups.filter(F.col(size) > HOT_ROWS).select(*keys))
    columns = [F.col(k) for k in keys]
    dealt = F.when(F.col("_bm_hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(0)
    copies = F.when(F.col("_bm_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = marked(rows, hot, columns, "_bm_hot").withColumn("_bm_salt", dealt.cast("int")).drop("_bm_hot")
    right = marked(groups, hot, columns, "_bm_hot").withColumn("_bm_salt", F.explode(copies)).drop("_bm_hot")
    return left.join(right, [*keys, "_bm_salt"], "left").drop("_bm_salt")
